"""Packing documents into sequences: dominance reduction, then best fit.

A packing depends only on how many pieces have each length, and there are at
most ``capacity`` lengths, so the plan is made from that histogram, whatever
the number of documents:

1. Martello-Toth reduction. For a longest open piece, a small set is fixed for
   good where it provably dominates every other set that could share its
   sequence: the piece alone if nothing else fits; the piece and the longest
   that fits, if that fills the rest or no two others fit together, or if no
   pair of others holds more; the piece and two others, if at most two fit and
   the pair beats every other pair piece by piece. Fixing repeats until
   nothing more can be proven, for all pieces of a length at once.
2. Best fit decreasing on what remains, again a whole length at a time:
   sequences with the same content are one group.

A plan is a list of groups: a number of sequences and the lengths in each.
Every step of best fit opens at most two groups more than it uses up, so a
plan has at most some multiples of ``capacity`` entries at any input size.
Documents then look up their place: a piece's rank among the pieces of its
length is its task's offset plus its number within the task.

Defined results: a null text is empty and gives the end id alone. Every row
is a document of its own, rows that share an id included; null ids stay null.
Other columns are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, ship
from .tokens import chunks, crc32, encoder, release, tokenizer_path, trim

CAPACITY = 4096
END_ID = 1
#: pieces cached, and characters encoded at once, where a worker's memory is shared with other work
FEW_PIECES, FEW_CHARS = 200_000, 500_000
Group = tuple[int, tuple[tuple[int, int], ...]]


def _fit(lengths: list[int], counts: dict[int, int], room: int, taken: tuple[int, ...] = ()) -> int:
    """Longest open length of at most ``room`` besides ``taken``, or 0."""
    for i in range(bisect.bisect_right(lengths, room) - 1, -1, -1):
        if counts[lengths[i]] > taken.count(lengths[i]):
            return lengths[i]
    return 0


def _smallest(lengths: list[int], counts: dict[int, int], n: int, but: int) -> list[int]:
    """The ``n`` smallest open pieces besides one of length ``but``."""
    out: list[int] = []
    for x in lengths:
        out += [x] * min(n - len(out), counts[x] - (x == but))
        if len(out) >= n:
            break
    return out


def _best_pair(lengths: list[int], counts: dict[int, int], room: int, but: int) -> list[tuple[int, int]]:
    """For each length x, the longest y <= x that fits beside it; (x, y) pairs."""
    out = []
    for x in lengths[: bisect.bisect_right(lengths, room)]:
        if counts[x] - (x == but) > 0:
            y = _fit(lengths, counts, min(x, room - x), (but, x))
            if y:
                out.append((x, y))
    return out


def reduce_dominated(hist: dict[int, int], capacity: int) -> tuple[list[Group], dict[int, int]]:
    """Sets fixed by dominance, and the histogram that is left."""
    counts, fixed = {k: v for k, v in hist.items() if v > 0}, []
    changed = True
    while changed:
        changed = False
        for a in sorted(counts, reverse=True):
            while counts.get(a, 0) > 0:
                chosen = _dominating(a, counts, capacity)
                if chosen is None:
                    break
                need = Counter(chosen)
                times = min(counts[k] // v for k, v in need.items())
                for k, v in need.items():
                    counts[k] -= v * times
                fixed.append((times, tuple(sorted(need.items(), reverse=True))))
                changed = True
            if counts.get(a) == 0:
                del counts[a]
        counts = {k: v for k, v in counts.items() if v > 0}
    return fixed, counts


def _dominating(a: int, counts: dict[int, int], capacity: int) -> tuple[int, ...] | None:
    lengths, room = sorted(k for k, v in counts.items() if v > 0), capacity - a
    b = _fit(lengths, counts, room, (a,))
    if not b:
        return (a,)
    low = _smallest(lengths, counts, 3, a)
    if b == room or len(low) < 2 or low[0] + low[1] > room:
        return (a, b)
    if len(low) == 3 and sum(low) <= room:
        return None  # three others fit: not tried
    pairs = _best_pair(lengths, counts, room, a)
    if max(x + y for x, y in pairs) <= b:
        return (a, b)
    y = max((y for x, y in pairs if x == b), default=0)
    if y and all(y2 <= y for _, y2 in pairs):
        return (a, b, y)
    return None


def best_fit_decreasing(hist: dict[int, int], capacity: int) -> list[Group]:
    """Groups of equal sequences, filled longest pieces first, each piece into
    the open sequence with the least room that still holds it."""
    by_room: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, n: int, items: tuple) -> None:
        if room not in by_room:
            by_room[room] = []
            bisect.insort(rooms, room)
        by_room[room].append([n, items])

    for length in sorted((k for k, v in hist.items() if v > 0), reverse=True):
        left = hist[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            group = by_room[room][-1] if at < len(rooms) else [left, ()]
            each = room // length
            whole = min(group[0], left // each)
            if whole:
                n, q = whole, each
            else:
                n, q = 1, left
            group[0] -= n
            if at < len(rooms) and not group[0]:
                by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
            put(room - q * length, n, (*group[1], (length, q)))
            left -= n * q
    return [(n, items) for groups in by_room.values() for n, items in groups]


def plan(hist: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Dominance reduction, then best fit on the rest."""
    fixed, rest = reduce_dominated(hist, capacity)
    return fixed + best_fit_decreasing(rest, capacity)


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int, lasting: bool) -> Iterator[pa.RecordBatch]:
    if not lasting:
        trim()
    task, enc, seen = TaskContext.get().partitionId(), encoder(tokenizer) if lasting else encoder(tokenizer, FEW_PIECES), Counter()
    size = {} if lasting else {"max_chars": FEW_CHARS}
    end = np.asarray([end_id], "<u4").tobytes()
    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        rows = []
        for i, j in chunks(texts, **size):
            for doc, data in zip(ids[i:j], enc.encode([t or "" for t in texts[i:j]])):
                data += end
                n = len(data) // 4
                for k, start in enumerate(range(0, n, capacity)):
                    length = min(capacity, n - start)
                    rows.append((doc, k, start, length, crc32(data[4 * start : 4 * (start + length)]), task, seen[length]))
                    seen[length] += 1
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nr"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
    if not lasting:
        release()


def _places(batches: Iterator[pa.RecordBatch], slots: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """slots: by length, rows (first rank, first sequence, a sequence's pieces, offset) by rank."""
    for b in batches:
        at = {n: k for k, n in enumerate(b.schema.names)}
        length, rank = b.column(at["length"]).to_numpy(), b.column(at["rank"]).to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for n in np.unique(length):
            mine = np.flatnonzero(length == n)
            t = slots[int(n)]
            first, seq, each, off = t[np.searchsorted(t[:, 0], rank[mine], side="right") - 1].T
            i = rank[mine] - first
            sequence[mine], offset[mine] = seq + i // each, off + i % each * n
        keep_cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*(b.column(at[c]) for c in keep_cols), pa.array(sequence), pa.array(offset)], names=[*keep_cols, "sequence_id", "offset"])


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    lasting: bool = True,
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    ``lasting``: a worker's pieces outlive a task, which is quicker; without, the
    memory is there for other work that the worker does next."""
    spark = docs.sparkSession
    ship(spark)
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    only = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = keep(
        only.mapInArrow(
            lambda it: _pieces(it, path, end_id, capacity, lasting),
            "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nr long",
        ),
        "pieces",
    )
    counts = pieces.groupBy("length", "part").agg((F.max("nr") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = keep(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    hist = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows

    rows: dict[int, list] = {}
    used: Counter = Counter()
    sequence = 0
    for n, items in plan(hist, capacity):
        offset = 0
        for length, each in items:
            rows.setdefault(length, []).append((used[length], sequence, each, offset))
            used[length] += n * each
            offset += length * each
        sequence += n
    slots = {k: np.asarray(v, np.int64) for k, v in rows.items()}
    ranked = pieces.join(counts.select("length", "part", "before"), ["length", "part"]).withColumn("rank", F.col("before") + F.col("nr"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        lambda it: _places(it, slots),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
