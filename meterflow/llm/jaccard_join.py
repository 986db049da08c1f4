"""N-gram Jaccard join by grouped prefixes.

A document's set holds its distinct shingles of ``words`` words (64-bit
hashes); two documents link when |A and B| / |A or B| >= 3/4. Copies with one
and the same set are one node, named by the smallest id.

1. One pass counts the shingles of all documents in a table of fixed size
   (``FREQUENCY`` counters; the tasks' tables are added up in slices). It gives
   all tasks one order of shingles, rare ones first; any order is exact. A
   shingle in many more documents than the square root of its counter's share
   stands out, so the lists of prefix shingles grow by a root of the input.
2. A set of n shingles has a prefix of n - ceil(3n/4) + 1: two linking sets
   share a shingle of their prefixes. Documents with identical prefixes and
   size form one group, and only groups are joined, by prefix shingle. Group
   pairs are filtered by size and by position (what can still match after the
   first common shingle).
3. Stars first: each shingle's list names one hub, the group where the shingle
   stands earliest, and groups of the list are verified against it alone.
   Whatever is then in one component needs no more comparing. The pairs of
   different components are compared in full, the list's largest component
   against the rest, so families of thousands of near copies cost their size,
   not its square, and no link between components is lost.
4. Group pairs are expanded to their members. Each set has a parity signature
   of about two bits a shingle; the bits in which two differ are a lower bound
   of the shingles in which the sets differ, so pairs that cannot link go. The
   others are verified on the whole sets, which are recomputed for the
   documents concerned alone.

Components come from alternating large and small stars.

Defined results: null and blank texts have an empty set, link with nothing and
are their own component. Rows that share an id are one vertex where that
id names their sets. A null id gets its n_shingles, links nothing and has a null component. Ties
don't occur: links are exact in integers. Other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, shared_path, ship, with_ids
from .tokens import trimmed

WORDS = 5
FREQUENCY = 1 << 21
SLICE = 1 << 16
_MIX = np.asarray([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def shingles(text: str | bytes | None, words: int = WORDS) -> np.ndarray:
    """Hashes (uint64) of a text's (or its UTF-8 bytes') runs of ``words`` words, in their order."""
    found = (text.encode() if isinstance(text, str) else text or b"").lower().split()  # ASCII: A-Z, and blanks 20, 09-0D
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    k = min(words, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        x = (w[i : len(w) - k + 1 + i] ^ _MIX[i % 8]) * _MIX[(i + 3) % 8]
        h = (h ^ (x ^ (x >> np.uint64(29)))) * _MIX[7] + _MIX[2]
    h ^= h >> np.uint64(32)
    h *= _MIX[4]
    h ^= h >> np.uint64(29)
    return h


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes (int64) of a text's shingles."""
    return np.unique(shingles(text, words).view(np.int64))


def set_id(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def signature(s: np.ndarray) -> bytes:
    """For each of 2**k >= 2n bits whether an odd number of shingles hash there."""
    bits = 1 << max(3, int(2 * len(s) - 1).bit_length())
    at = (s ^ (s >> 33)) & (bits - 1)
    return np.packbits(np.bincount(at, minlength=bits) & 1).tobytes()


def may_be_linked(n: int, m: int, a: bytes, b: bytes) -> bool:
    """Whether two sets of n and m shingles can link, by their signatures."""
    if 4 * min(n, m) < 3 * max(n, m):
        return False
    while len(a) != len(b):  # the longer one folds to the shorter one's bits
        a, b = (a, b) if len(a) > len(b) else (b, a)
        a = (int.from_bytes(a[: len(a) // 2]) ^ int.from_bytes(a[len(a) // 2 :])).to_bytes(len(a) // 2)
    differ = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    return 7 * (n + m - differ) >= 6 * (n + m)  # |A and B| <= (n + m - differ) / 2


def prefix(s: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The rarest n - ceil(3n/4) + 1 shingles, rarest first."""
    n = len(s)
    order = np.argsort(often[s & (FREQUENCY - 1)], kind="stable")
    return s[order[: n - -(-3 * n // 4) + 1]]


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Kind 0: id, size, set id of each document. Kind 1: slice, its counters."""
    counts = np.zeros(FREQUENCY, np.int64)
    for b in batches:
        sets = [shingle_set(t.as_py(), words) for t in b.column(1)]
        n = len(sets)
        names = ["kind", "id", "n", "fp"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(n, np.int32)), b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) if len(s) else None for s in sets], pa.binary())], names=names,
        )
        step = 2000  # sets counted at a time
        for i in range(0, n, step):
            counts += np.bincount(np.concatenate(sets[i : i + step]) & (FREQUENCY - 1), minlength=FREQUENCY)
    at, packed = _pack({i: c for i, c in enumerate(counts.reshape(-1, SLICE)) if c.any()})
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(at), np.int32)), at, pa.nulls(len(at), pa.int64()), packed], names=["kind", "id", "n", "fp"])


def _pack(slices: dict[int, np.ndarray]) -> list[pa.Array]:
    return [pa.array(list(slices), pa.int64()), pa.array([zlib.compress(c.tobytes(), 1) for c in slices.values()], pa.binary())]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of counters, added up: FREQUENCY of them in memory at most."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for i, z in zip(b.column(0).to_pylist(), b.column(1)):
            c = np.frombuffer(zlib.decompress(z.as_py()), np.int64)
            total[i] = total[i] + c if i in total else c
    yield pa.RecordBatch.from_arrays(_pack(total), names=["id", "fp"])


def _postings(batches: Iterator[pa.RecordBatch], often: np.ndarray, words: int) -> Iterator[pa.RecordBatch]:
    """(token, n, pos, g, fp, sig): prefix shingles once per group and batch; a
    row with pos -1, set id and signature for each member."""
    for b in batches:
        parts, done, members = [], set(), {}
        for t in b.column(0):
            s = shingle_set(t.as_py(), words)
            if not len(s):
                continue
            p = prefix(s, often)
            g = np.int64(xxhash.xxh3_64_intdigest(p.tobytes(), len(s)) - (1 << 63))
            members[(int(g), set_id(s))] = (len(s), signature(s))
            if int(g) not in done:
                done.add(int(g))
                parts.append((p, np.full(len(p), len(s), np.int32), np.arange(len(p), dtype=np.int32), np.full(len(p), g)))
            if len(parts) >= 500:
                yield _posting_batch(parts, {})
                parts = []
        if parts or members:
            yield _posting_batch(parts, members)


def _posting_batch(parts: list, members: dict) -> pa.RecordBatch:
    g = np.asarray([k[0] for k in members], np.int64)
    parts = [*parts, (g, np.fromiter((v[0] for v in members.values()), np.int32, len(g)), np.full(len(g), -1, np.int32), g)]
    cols = [np.concatenate(c) for c in zip(*parts)]
    none = pa.nulls(len(cols[0]) - len(g), pa.binary())
    fps = pa.concat_arrays([none, pa.array([k[1] for k in members], pa.binary())])
    sigs = pa.concat_arrays([none, pa.array([v[1] for v in members.values()], pa.binary())])
    return pa.RecordBatch.from_arrays([*map(pa.array, cols), fps, sigs], names=["token", "n", "pos", "g", "fp", "sig"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token, pos, n, g. Kind 0: members (g, n, fp, sig). Kind 1: the
    postings of lists with two groups or more, with the list's hub (its first
    posting). Holds one row from one batch to the next, whatever a list's length."""
    token, hub, told = None, None, False
    names = ["kind", "token", "n", "pos", "g", "hub", "hub_n", "hub_pos", "fp", "sig"]

    def rows(t, n, pos, g, hg, hn, hp):
        cols = [np.ones(len(t), np.int32), t, n, pos, g, hg, hn, hp]
        return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.nulls(len(t), pa.binary()), pa.nulls(len(t), pa.binary())], names=names)

    for b in batches:
        t, n, pos, g = (b.column(i).to_numpy() for i in range(4))
        mine = np.flatnonzero(pos < 0)
        if len(mine):
            k = len(mine)
            none = [pa.nulls(k, x) for x in (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())]
            none[1], none[3] = pa.array(n[mine]), pa.array(g[mine])
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, np.int32)), *none, *(b.column(i).take(pa.array(mine)) for i in (4, 5))], names=names)
        keep_rows = pos >= 0
        t, n, pos, g = t[keep_rows], n[keep_rows], pos[keep_rows], g[keep_rows]
        if not len(t):
            continue
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (g[1:] != g[:-1])
        if token is not None and t[0] == token and g[0] == last_g:
            new[0] = False
        last_g = g[-1]
        t, n, pos, g = t[new], n[new], pos[new], g[new]
        if not len(t):
            continue
        first = np.ones(len(t), bool)
        first[1:] = t[1:] != t[:-1]
        goes_on = token is not None and t[0] == token
        first[0] = not goes_on
        at = np.maximum.accumulate(np.where(first, np.arange(len(t)), -1))
        hg, hn, hp = (np.where(at >= 0, x[np.maximum(at, 0)], y) for x, y in zip((g, n, pos), hub or (0, 0, 0)))
        if goes_on and not told:
            yield rows(*(np.asarray([x], d) for x, d in zip((token, hub[1], hub[2], hub[0], hub[0], hub[1], hub[2]), (np.int64, np.int32, np.int32, np.int64, np.int64, np.int32, np.int32))))
        length = np.append(np.flatnonzero(first)[1:], len(t)) - np.flatnonzero(first)
        alone = first.copy()
        alone[np.flatnonzero(first)] = length == 1
        out = ~alone
        if out.any():
            yield rows(t[out], n[out], pos[out], g[out], hg[out], hn[out].astype(np.int32), hp[out].astype(np.int32))
        told = bool(out[-1])
        token, hub = t[-1], (hg[-1], hn[-1], hp[-1])


def may_link(n, pos, hub_n, hub_pos):
    """Sizes within 3/4, and enough shingles left from the common one on:
    |A and B| >= 3/7 (|A| + |B|)."""
    return (
        (4 * F.least(n, hub_n) >= 3 * F.greatest(n, hub_n))
        & (7 * F.least(n - pos, hub_n - hub_pos) >= 3 * (n + hub_n))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of undirected edges (a, b), component the smallest
    node reachable, by alternating large and small stars."""
    e = keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = keep(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pulled = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = keep(pulled.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        seen = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def _whole_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, fps, sets = [], [], []
        for i, t in zip(b.column(0).to_pylist(), b.column(1)):
            s = shingle_set(t.as_py(), words)
            if len(s):
                ids.append(i), fps.append(set_id(s)), sets.append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fps, pa.binary()), pa.array(sets, pa.binary())], names=["rep", "fp", "s"])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * |A and B| >= 75 * |A or B|, of sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 4 * len(a) < 3 * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok = [linked(np.frombuffer(x.as_py(), np.int64), np.frombuffer(y.as_py(), np.int64)) for x, y in zip(b.column(2), b.column(3))]
        yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Per row of ``docs``: the id, n_shingles, component_id."""
    spark = docs.sparkSession
    ship(spark)
    only = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    path = shared_path(spark, "shingle-sets")
    kinds = "kind int, id long, n long, fp binary"
    only.mapInArrow(trimmed(lambda it: _sets(it, words)), kinds).write.partitionBy("kind").parquet(path)
    stored = spark.read.schema(kinds).parquet(path)
    nodes = stored.filter("kind = 0").select("id", "n", "fp")

    often = np.zeros(FREQUENCY, np.int32)  # at most FREQUENCY counters come here
    slices = stored.filter("kind = 1").select("id", "fp").mapInArrow(_counted, "id long, fp binary")
    for i, z in slices.repartition("id").mapInArrow(_counted, "id long, fp binary").collect():
        often[i * SLICE : (i + 1) * SLICE] = np.minimum(np.frombuffer(zlib.decompress(z), np.int64), 2**31 - 1)
    sent = spark.sparkContext.broadcast(often)

    path = shared_path(spark, "prefix-lists")
    kinds = "kind int, token long, n int, pos int, g long, hub long, hub_n int, hub_pos int, fp binary, sig binary"
    (
        only.filter("id IS NOT NULL").select("text")
        .mapInArrow(trimmed(lambda it: _postings(it, sent.value, words)), "token long, n int, pos int, g long, fp binary, sig binary")
        .repartition("token").sortWithinPartitions("token", "pos", "n", "g")
        .mapInArrow(trimmed(_lists), kinds).write.partitionBy("kind").parquet(path)
    )
    stored = spark.read.schema(kinds).parquet(path)
    lists = stored.filter("kind = 1").drop("kind", "fp", "sig")
    reps = keep(nodes.filter("fp IS NOT NULL AND id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("rep")), "set-reps")
    members = keep(stored.filter("kind = 0").select("g", "n", "fp", "sig").distinct().join(reps, "fp").select("g", "rep", "n", "sig"), "group-members")
    signatures, members = members.select("rep", "n", "sig"), members.select("g", "rep")
    group_rep = members.groupBy("g").agg(F.min("rep").alias("head"))

    # stars: every group against the hubs of its lists, every member of a group against the head
    stars = lists.filter(F.col("g") != F.col("hub")).filter(may_link(F.col("n"), F.col("pos"), F.col("hub_n"), F.col("hub_pos"))).select("g", "hub").distinct()
    pairs = (
        stars.join(members, "g").join(group_rep.select(F.col("g").alias("hub"), "head"), "hub")
        .select(F.col("rep").alias("a"), F.col("head").alias("b"))
        .unionAll(members.join(group_rep, "g").select(F.col("rep").alias("a"), F.col("head").alias("b")))
    )
    sets = _Sets(only, signatures, words)
    edges = sets.verified(pairs)
    label = components(edges)

    # the rest: pairs of different components, in lists and in groups
    labelled = keep(members.join(label, members["rep"] == label["node"], "left").select("g", "rep", F.coalesce("component", "rep").alias("label")), "group-labels")
    posted = lists.select("token", "n", "pos", "g").join(labelled, "g")
    inside = labelled.select(F.col("g").alias("token"), F.lit(0).alias("n"), F.lit(0).alias("pos"), "g", "rep", "label")
    more = _across(posted, lambda x, y: may_link(x["n"], x["pos"], y["n"], y["pos"])).unionAll(_across(inside, None))
    edges = edges.unionAll(sets.verified(more))
    label = components(edges)

    named = reps.join(label, reps["rep"] == label["node"], "left").select("fp", F.coalesce("component", "rep").alias("component"))
    out = nodes.join(named.withColumnRenamed("fp", "of"), nodes["fp"] == F.col("of"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def _across(posted: DataFrame, may) -> DataFrame:
    """Pairs (a, b) of one list and different labels: the rows of all labels
    but the list's largest, against the list."""
    sizes = posted.groupBy("token", "label").agg(F.count(F.lit(1)).alias("size"))
    top = sizes.groupBy("token").agg(F.max_by("label", F.struct("size", "label")).alias("most"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    mixed = posted.join(top.select("token", "most"), "token")
    # a pair whose shingles before this one are the same has met there already
    before = Window.partitionBy("g", "rep").orderBy("pos", "token")  # a prefix at most
    mixed = keep(mixed.withColumn("prev", F.lag("token").over(before)), "mixed-lists")
    x, y = mixed.filter("label <> most").alias("x"), mixed.alias("y")
    cond = (F.col("x.token") == F.col("y.token")) & (F.col("x.label") != F.col("y.label"))
    cond = cond & ~F.coalesce(F.col("x.prev") == F.col("y.prev"), F.lit(False))
    cond = cond & ((F.col("y.label") == F.col("y.most")) | (F.col("x.rep") < F.col("y.rep")))
    if may is not None:
        side = {s: {c: F.col(f"{s}.{c}") for c in ("n", "pos")} for s in "xy"}
        cond = cond & may(side["x"], side["y"])
    return x.join(y, cond).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok = [may_be_linked(*r) for r in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5)))]
        yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


class _Sets:
    """Verifies pairs of representatives, by signature and on whole sets."""

    def __init__(self, docs: DataFrame, signatures: DataFrame, words: int):
        self.docs, self.signatures, self.words = docs, signatures, words

    def _both(self, pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
        x = table.select(F.col("rep").alias("a"), *[F.col(c).alias(f"x_{c}") for c in columns])
        y = table.select(F.col("rep").alias("b"), *[F.col(c).alias(f"y_{c}") for c in columns])
        return pairs.join(x, "a").join(y, "b").select("a", "b", *[f"{s}_{c}" for c in columns for s in "xy"])

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b), a <> b, that link."""
        words = self.words
        pairs = pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        pairs = keep(self._both(pairs, self.signatures, ["n", "sig"]).mapInArrow(trimmed(_possible), "a long, b long").distinct(), "candidates")
        if pairs.isEmpty():
            return pairs
        wanted = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
        chosen = with_ids(self.docs.filter("id IS NOT NULL"), wanted).mapInArrow(trimmed(lambda it: _whole_sets(it, words)), "rep long, fp binary, s binary")
        sets = keep(chosen, "sets")
        return keep(self._both(pairs, sets, ["s"]).mapInArrow(trimmed(_verify), "a long, b long"), "links")
