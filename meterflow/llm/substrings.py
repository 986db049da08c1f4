"""Fuzzy passage dedup by collinear chaining.

1. Seeds: of every ``WINDOW`` consecutive k-mers of ``K`` words the one with the
   least hash, so that any ``WINDOW + K - 1`` words two documents share hold a
   common seed.
2. A seed's occurrences are matched with its first holder alone (smallest id,
   first place): a passage in a third of all documents costs its occurrences,
   not their square. The list of a seed is read as a stream.
3. The matches of two documents are chained in order: a chain's score is its
   anchors' words less a cost for the gaps between them, and a Fenwick tree over
   the places in the holder gives each anchor its best predecessor.
4. Chains are aligned word by word over the chain and ``min_words`` on each
   side, across substitutions, insertions and deletions, and passages of at
   least ``min_words`` words and ``min_identity`` are returned. The alignment
   may run on over words whose seeds belong to another holder. Chains of two
   documents whose windows overlap in both travel as one row with one span of
   words from each, so a text that repeats itself is cut and sent once.

5. The rest: a passage whose seeds all have first holders that lack it. Where the
   seeds of ``min_words`` words in a row all occur before and no reported passage
   holds these words, every run of ``min_words`` words of all documents that hold
   such seeds in a row is matched with its own first holder, which then holds the
   run whole, and is aligned like a chain. So no run of ``min_words`` words that
   an earlier document holds, too, is left out, whoever holds its parts. (Exact
   for ``min_words`` of at least ``WINDOW + K - 1``.)

Words are runs without ASCII white space, A-Z lower-cased; places count words.

Defined results: null and empty texts, and texts of fewer than K words, have
no seeds. A null id cannot be named and is left out. Rows that share an id are
one document: a passage repeated only among them is not reported. Repeats
within one text are not across documents. Other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, ship, unpacked_text, with_ids
from .jaccard_join import shingles

K = 6
WINDOW = 11
MIN_WORDS = 50
MIN_IDENTITY = 0.8
GAP_COST = 0.1
MAX_GAP = 30
#: words an alignment may skip at one difference, and its score may fall below its best
MAX_SKIP, DROP = 8, 15


def seeds(text: str | bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of a text's winnowed k-mers."""
    h = shingles(text, K)
    if len(h) < 2 and len((text or b"").split(None, K - 1)) < K:  # too few words
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    if len(h) <= WINDOW:
        at = np.asarray([int(h.argmin())])
    else:
        view = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
        at = np.unique(view.argmin(axis=1) + np.arange(len(view)))
    return h[at].view(np.int64), at.astype(np.int32)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = b.slice(i, 500)
            got = [seeds(t.as_py()) for t in part.column(1).cast(pa.binary())]
            ids = np.repeat(part.column(0).to_numpy(), [len(h) for h, _ in got])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h for h, _ in got])), pa.array(ids), pa.array(np.concatenate([p for _, p in got]))], names=["seed", "doc", "pos"])


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by seed, doc, pos: each occurrence of a seed that has several,
    with the seed's first holder and place there, the first place itself included.
    Keeps one row between batches."""
    last = None  # seed, holder, place, whether its own row has been given
    for b in batches:
        seed, doc, pos = (b.column(i).to_numpy() for i in range(3))
        if not len(seed):
            continue
        pos = pos.astype(np.int32)
        first = np.ones(len(seed), bool)
        first[1:] = seed[1:] != seed[:-1]
        own = None
        if last is not None and seed[0] == last[0]:
            first[0] = False
            own = None if last[3] else last
        at = np.maximum.accumulate(np.where(first, np.arange(len(seed)), -1))
        holder, place = (np.where(at >= 0, x[np.maximum(at, 0)], y) for x, y in zip((doc, pos), (last or (0, 0, 0))[1:]))
        out = ~first
        out[:-1] |= ~first[1:]  # a first place that others follow
        last = (seed[-1], holder[-1], place[-1], bool(out[-1]))
        cols = [doc[out], holder[out], pos[out], place[out].astype(np.int32)]
        if own:
            cols = [np.concatenate([np.asarray([v], c.dtype), c]) for v, c in zip((own[1], own[1], own[2], own[2]), cols)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["doc", "of", "x", "y"])


class Fenwick:
    """Prefix maxima of (score, anchor) over ranks."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def upto(self, i: int) -> tuple[float, int]:
        """Over the ranks below ``i``."""
        top = (float("-inf"), -1)
        while i > 0:
            if self.best[i] > top:
                top = self.best[i]
            i -= i & -i
        return top


def chains(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(x first, x last, y first, y last) of the chains of anchors sorted by x."""
    d = x - y
    if (d == d[0]).all():  # one diagonal: nothing to choose
        cut = np.flatnonzero(np.diff(x) > MAX_GAP) + 1
        return [(int(p[0]), int(p[-1]), int(p[0] - d[0]), int(p[-1] - d[0])) for p in np.split(x, cut)]
    rank = np.searchsorted(np.unique(y), y)
    tree, score, before = Fenwick(int(rank.max()) + 1), [0.0] * len(x), [-1] * len(x)
    waiting: list[int] = []
    xs, ys, rs = x.tolist(), y.tolist(), rank.tolist()
    for i in range(len(xs)):
        while waiting and xs[waiting[0]] < xs[i]:  # anchors of one x do not follow each other
            j = waiting.pop(0)
            tree.put(rs[j], (score[j] + GAP_COST * (xs[j] + ys[j]), j))
        value, j = tree.upto(rs[i])
        gain = value - GAP_COST * (xs[i] + ys[i])
        near = j >= 0 and xs[i] - xs[j] <= MAX_GAP + K and ys[i] - ys[j] <= MAX_GAP + K
        if near and gain > 0:
            score[i], before[i] = K + gain, j
        else:
            score[i] = K
        waiting.append(i)
    used, out = [False] * len(xs), []
    for i in sorted(range(len(xs)), key=lambda i: -score[i]):
        if used[i]:
            continue
        end = start = i
        while True:
            used[start] = True
            if before[start] < 0 or used[before[start]]:
                break
            start = before[start]
        out.append((xs[start], xs[end], ys[start], ys[end]))
    return out


def overlapping(c: np.ndarray, min_words: int) -> list[np.ndarray]:
    """Chains (rows of x first, x last, y first, y last) in groups whose windows
    overlap one another, without a gap in x or in y."""
    for side in (0, 2):
        if len(c) < 2:
            break
        c = c[np.argsort(c[:, side], kind="stable")]
        reach = np.maximum.accumulate(c[:, side + 1]) + K + 2 * min_words
        cut = np.flatnonzero(c[1:, side] > reach[:-1]) + 1
        if len(cut):
            return [g for part in np.split(c, cut) for g in overlapping(part, min_words)]
    return [c]


def known_runs(places: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Words (low, high) in which every seed inside ``min_words`` words may be one
    of ``places`` (sorted): seeds are ``WINDOW`` places apart at most."""
    runs = np.split(places, np.flatnonzero(np.diff(places) > WINDOW) + 1)
    spans = [(max(0, int(r[0]) - WINDOW + 1), int(r[-1]) + K + WINDOW - 1) for r in runs if len(r)]
    return [(low, high) for low, high in spans if high - low >= min_words]


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Rows of whole numbers sorted by their first column, in blocks that hold all
    rows of a document. Holds those of one document."""
    rest: list[np.ndarray] | None = None
    for b in batches:
        cols = [b.column(i).to_numpy().astype(np.int64) for i in range(b.num_columns)]
        if rest is not None:
            cols = [np.concatenate(p) for p in zip(rest, cols)]
        if not len(cols[0]):
            continue
        start = int(np.searchsorted(cols[0] == cols[0][-1], True))
        rest = [c[start:] for c in cols]
        if start:
            yield [c[:start] for c in cols]
    if rest is not None and len(rest[0]):
        yield rest


def _chains(batches: Iterator[pa.RecordBatch], min_words: int, least: int, regions: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by doc, of, x, y. Holds the matches of one document. A match
    counts if its neighbours, with whatever holders, span ``least`` words, which
    the seeds of a passage of ``min_words`` words must span: chance matches stand
    alone. Gives a row per group of overlapping chains of two documents: the spans
    of words to read, and the chains as numbers in fours. ``regions``: and a row
    without ``of`` for each run of words whose seeds all have earlier holders."""
    names = ["doc", "of", "x_low", "x_high", "y_low", "y_high", "chains"]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.list_(pa.int32())]

    def out(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        again = np.zeros(len(cols[0]), bool)  # rows that share an id
        again[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in cols])
        cols = [c[~again] for c in cols]
        doc = cols[0]
        cut, rows = [0, *(np.flatnonzero(doc[1:] != doc[:-1]) + 1), len(doc)], []
        for a, z in zip(cut, cut[1:]):
            of, x, y = (c[a:z] for c in cols[1:])
            places = np.unique(x)
            if regions:
                rows += [(int(doc[a]), None, low, high, None, None, None) for low, high in known_runs(places, min_words)]
            runs = np.split(places, np.flatnonzero(np.diff(places) > MAX_GAP + K) + 1)
            good = np.concatenate([r for r in runs if r[-1] - r[0] >= least] or [places[:0]])
            ok = np.isin(x, good)
            of, x, y = of[ok], x[ok], y[ok]
            pair = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1), len(of)]
            for p, q in zip(pair, pair[1:]):
                if q == p:
                    continue
                for c in overlapping(np.asarray(chains(x[p:q], y[p:q])), min_words):
                    low, high = np.maximum(c.min(axis=0) - min_words, 0), c.max(axis=0) + K + min_words
                    rows.append((int(doc[a]), int(of[p]), low[0], high[1], low[2], high[3], c.ravel()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for cols in _by_document(batches):
        yield from out(cols)


def _uncovered(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc, regions, passages): the parts of the regions in which no run of
    ``min_words`` words stands inside one passage."""
    for b in batches:
        docs, parts = [], []
        for d, regions, passages in zip(*(b.column(i).to_pylist() for i in range(3))):
            left = []
            for low, high in ((r["low"], r["high"]) for r in regions):
                todo = np.ones(high - min_words + 1 - low, bool)  # a run by its first word
                for p in passages or ():
                    todo[max(0, p["start"] - low) : max(0, p["end"] - min_words + 1 - low)] = False
                at = np.flatnonzero(todo) + low
                left += [{"low": int(r[0]), "high": int(r[-1]) + min_words} for r in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(r)]
            if left:
                docs.append(d)
                parts.append(left)
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(parts, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())])))], names=["doc", "parts"])


def _known(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc, x) sorted: a document's runs of words with these places."""
    for doc, x in _by_document(batches):
        docs, windows = [], []
        for one in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1):
            runs = known_runs(np.unique(x[one]), min_words)
            if runs:
                docs.append(int(doc[one[0]]))
                windows.append([{"low": low, "high": high} for low, high in runs])
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(windows, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())])))], names=["id", "windows"])


def _runs(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(id, windows, packed text): the hash of every ``min_words`` words inside a window, with its place."""
    for b in batches:
        for i, windows, size, body in zip(*(b.column(k) for k in range(4))):
            text = unpacked_text(size.as_py(), body.as_py())
            if len(text.split(None, min_words - 1)) < min_words:
                continue
            h = shingles(text, min_words).view(np.int64)
            at = np.unique(np.concatenate([np.arange(w["low"], min(w["high"] - min_words + 1, len(h))) for w in windows.as_py()]))
            for k in range(0, len(at), 100_000):
                p = at[k : k + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(h[p]), pa.array(np.full(len(p), i.as_py(), np.int64)), pa.array(p.astype(np.int32))], names=["seed", "doc", "pos"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, windows, packed text): for each window its words, deflated, as they are kept and shuffled twice."""
    for b in batches:
        for i, windows, size, body in zip(*(b.column(k) for k in range(4))):
            words = unpacked_text(size.as_py(), body.as_py()).lower().split()
            spans = [(w["low"], w["high"]) for w in windows.as_py()]
            for k in range(0, len(spans), 1000):
                low, high = zip(*spans[k : k + 1000])
                cols = [pa.array([i.as_py()] * len(low), pa.int64()), pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.array([zlib.compress(b" ".join(words[x:y]), 6) for x, y in zip(low, high)], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "low", "high", "words"])


def extend(a: list[bytes], b: list[bytes], i: int, j: int) -> tuple[int, int, int]:
    """Align from (i, j) on: (end in a, end in b, words matched). Across a
    difference the nearest place with two equal words in a row goes on. A
    matched word counts 1, a skipped one -1; the best end counts, and the
    alignment stops ``DROP`` below it."""
    n, m = len(a), len(b)
    matched = score = 0
    best = (0, i, j, 0)
    while True:
        while (run := a[i : i + 16]) and run == b[j : j + 16]:
            i, j, matched, score = i + len(run), j + len(run), matched + len(run), score + len(run)
        while i < n and j < m and a[i] == b[j]:
            i, j, matched, score = i + 1, j + 1, matched + 1, score + 1
        if score > best[0]:
            best = (score, i, j, matched)
        if i >= n or j >= m or score < best[0] - DROP:
            break
        # the sides may skip unequal numbers of words
        pairs = zip(a[i : i + MAX_SKIP + 1], a[i + 1 : i + MAX_SKIP + 2])
        place: dict[tuple, int] = {}
        for dj, two in enumerate(zip(b[j : j + MAX_SKIP + 1], b[j + 1 : j + MAX_SKIP + 2])):
            place.setdefault(two, dj)
        found = min(((di + place[two], di, place[two]) for di, two in enumerate(pairs) if two in place), default=None)
        if not found:
            break
        i, j, score = i + found[1], j + found[2], score - max(found[1:])
    return best[1], best[2], best[3]


def align(a: list[bytes], b: list[bytes], found: np.ndarray, min_words: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(start, end, start in b, end in b, words matched) of each chain, aligned
    in its own window. Windows of equal words are aligned once."""
    known: dict[tuple, tuple] = {}
    for x0, x1, y0, y1 in found.tolist():
        left, under = max(0, x0 - min_words), max(0, y0 - min_words)
        wa, wb, i, j = a[left : x1 + K + min_words], b[under : y1 + K + min_words], x0 - left, y0 - under
        key = (b" ".join(wa), i, y0, y1)
        if key not in known:
            right_i, right_j, m1 = extend(wa, wb, i, j)
            left_i, left_j, m2 = extend(wa[:i][::-1], wb[:j][::-1], 0, 0)
            known[key] = (i - left_i, right_i, j - left_j, right_j, m1 + m2)
        start, end, of_start, of_end, matched = known[key]
        yield left + start, left + end, under + of_start, under + of_end, matched


def _align(batches: Iterator[pa.RecordBatch], min_words: int, min_identity: float) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "end", "of_doc", "of_start", "of_end", "matched", "identity"]
    kinds = [pa.int64()] * 7 + [pa.float64()]
    for batch in batches:
        rows = []
        for k in range(batch.num_rows):
            doc, of, x_low, y_low, found, words_x, words_y = (batch.column(i)[k].as_py() for i in range(7))
            c = np.asarray(found).reshape(-1, 4) - (x_low, x_low, y_low, y_low)
            for start, end, of_start, of_end, matched in align(zlib.decompress(words_x).split(), zlib.decompress(words_y).split(), c, min_words):
                n = max(end - start, of_end - of_start)
                if min(end - start, of_end - of_start) >= min_words and matched >= min_identity * n:
                    rows.append((doc, x_low + start, x_low + end, of, y_low + of_start, y_low + of_end, matched, round(matched / n, 6)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _matched(seeds: DataFrame) -> DataFrame:
    return seeds.repartition("seed").sortWithinPartitions("seed", "doc", "pos").mapInArrow(_matches, "doc long, of long, x int, y int")


def _passages(only: DataFrame, found: DataFrame, min_words: int, min_identity: float) -> DataFrame:
    """The passages of chains: their words are cut, brought together and aligned."""
    asked = found.select(F.col("doc").alias("id"), F.col("x_low").alias("low"), F.col("x_high").alias("high"))
    asked = asked.unionAll(found.select("of", "y_low", "y_high")).groupBy("id").agg(F.collect_set(F.struct("low", "high")).alias("windows"))
    asked = keep(asked, "windows")
    cut = asked.join(with_ids(only, asked.select("id"), packed=True), "id").select("id", "windows", "size", "body").mapInArrow(_cut, "id long, low int, high int, words binary")
    cut = keep(cut, "window-words")
    x = cut.select(F.col("id").alias("doc"), F.col("low").alias("x_low"), F.col("high").alias("x_high"), F.col("words").alias("words_x"))
    y = cut.select(F.col("id").alias("of"), F.col("low").alias("y_low"), F.col("high").alias("y_high"), F.col("words").alias("words_y"))
    both = found.join(x, ["doc", "x_low", "x_high"]).join(y, ["of", "y_low", "y_high"]).select("doc", "of", "x_low", "y_low", "chains", "words_x", "words_y")
    kind = "doc_id long, start long, end long, of_doc long, of_start long, of_end long, matched long, identity double"
    return keep(both.mapInArrow(lambda it: _align(it, min_words, min_identity), kind).distinct(), "passages")


def _rest(only: DataFrame, matches: DataFrame, regions: DataFrame, got: DataFrame, min_words: int) -> DataFrame:
    """Matches (doc, of, x, y) of whole runs of ``min_words`` words, for the
    documents that may hold a run of the ``regions`` which no passage of ``got`` holds."""
    spans = "array<struct<low: int, high: int>>"
    asked = regions.groupBy("doc").agg(F.collect_list(F.struct(F.col("x_low").alias("low"), F.col("x_high").alias("high"))).alias("regions"))
    said = got.groupBy(F.col("doc_id").alias("doc")).agg(F.collect_list(F.struct("start", "end")).alias("passages"))
    left = asked.join(said, "doc", "left").select("doc", "regions", "passages").mapInArrow(lambda it: _uncovered(it, min_words), f"doc long, parts {spans}")
    left = keep(left, "uncovered")
    # a seed is named by its first holder and place
    wanted = matches.where("doc <> of").join(left, "doc").where(F.exists("parts", lambda p: (F.col("x") >= p["low"]) & (F.col("x") + K <= p["high"]))).select("of", "y").distinct()
    held = matches.join(wanted, ["of", "y"], "left_semi").select("doc", "x")
    windows = keep(held.repartition("doc").sortWithinPartitions("doc", "x").mapInArrow(lambda it: _known(it, min_words), f"id long, windows {spans}"), "known-runs")
    runs = windows.join(with_ids(only, windows.select("id"), packed=True), "id").select("id", "windows", "size", "body").mapInArrow(lambda it: _runs(it, min_words), "seed long, doc long, pos int")
    # others of a run's holders have a passage that holds it
    inside = F.exists("parts", lambda p: (F.col("x") >= p["low"]) & (F.col("x") + min_words <= p["high"]))
    return _matched(runs).where("doc <> of").join(left, "doc").where(inside).select("doc", "of", "x", "y")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_identity: float = MIN_IDENTITY) -> DataFrame:
    """A row per passage of a document (doc_id, start, end) that an earlier
    document holds too (of_doc, of_start, of_end), with the words matched and
    their share (identity)."""
    ship(docs.sparkSession)
    only = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id IS NOT NULL")
    chained = "doc long, of long, x_low int, x_high int, y_low int, y_high int, chains array<int>"

    def chain(matches: DataFrame, least: int, regions: bool) -> DataFrame:
        near = matches.repartition("doc").sortWithinPartitions("doc", "of", "x", "y")
        return keep(near.mapInArrow(lambda it: _chains(it, min_words, least, regions), chained), "chains")

    matches = keep(_matched(only.mapInArrow(_seeds, "seed long, doc long, pos int")), "matches")
    both = chain(matches.where("doc <> of"), max(0, min_words - 2 * (WINDOW + K - 1)), True)
    got = _passages(only, both.where("of IS NOT NULL"), min_words, min_identity)
    more = chain(_rest(only, matches, both.where("of IS NULL"), got, min_words), 0, False)
    got = got.unionByName(_passages(only, more, min_words, min_identity)).distinct()
    # chains of one passage extend to the same words: a passage within another goes
    w = Window.partitionBy("doc_id", "of_doc").orderBy("start", F.desc("end"), F.desc("matched"), "of_start", "of_end")
    reached = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return got.withColumn("r", reached).filter("r IS NULL OR end > r").drop("r")
