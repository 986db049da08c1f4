"""Exact top-k inner products by distributed histogram selection.

Vectors are cut into blocks of ``block`` rows and so are the queries; every
vector block meets every query block through an equi-join on the query block's
number, and a pair of blocks is scored by one matrix product, never written
out. Three things are done with the scores, each a pass of its own:

1. Rounds of refinement. Each pair of blocks counts its scores per query in
   ``bins`` equal bins of the query's present range. Spark adds the counts up,
   and the bin that holds the k-th highest score becomes the next range, until
   it is one score wide. The first range follows from the largest absolute
   components (an upper bound of every score). A pair needs to send only its
   topmost bins down to its own k-th score: the global k-th cannot lie below.
2. A filter: the pairs of blocks send the scores at or above the k-th value.
   Scores equal to it are tied; a pair sends the smallest ids of its ties.
3. A window per query breaks ties by the smaller id and numbers the ranks.

Components are floor(scale * x), x as double. Scores are exact: products run
in float64 where every sum stays under 2**53. Otherwise they run in int64, where
a sum that fits a long comes out right whatever wraps on the way, and a float64
product tells whether it fits; only near the ends of a long Python's integers
decide. Ranges are kept as unsigned longs, scores + 2**63.

Defined results: a vector that is null, empty, or holds null or non-finite
components takes no part, as do null ids. Only vectors of equal length meet.
Rows with a query's own id are never its candidates; a repeated query id asks
once, with its smallest vector; repeated candidate rows are candidates each.
Fewer than k candidates give fewer rows; an empty table gives none. A score that
does not fit a long is an error that names its two ids (a query's own vector is
no candidate and may have any).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, ship

BLOCK = 2048
BINS = 256


def _blocks(batches: Iterator[pa.RecordBatch], scale: float, block: int) -> Iterator[pa.RecordBatch]:
    """(id, vector) rows into blocks: dim, n, top (largest |component|), ids and ints as bytes."""
    waiting: dict[int, tuple[list, list]] = {}

    def out(dim, ids, rows):
        ints = np.floor(scale * np.asarray(rows, np.float64))
        if np.abs(ints).max(initial=0) >= 2.0**62:
            raise ValueError("a component does not fit a long")
        ints = ints.astype(np.int64)
        cols = [[dim], [len(ids)], [int(np.abs(ints).max())], [np.asarray(ids, np.int64).tobytes()], [ints.tobytes()]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["dim", "n", "top", "ids", "ints"])

    for b in batches:
        for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
                continue
            ids, rows = waiting.setdefault(len(v), ([], []))
            ids.append(i)
            rows.append(v)
            if len(ids) >= block:
                yield out(len(v), *waiting.pop(len(v)))
    for dim, (ids, rows) in waiting.items():
        yield out(dim, ids, rows)


ZERO = np.uint64(1 << 63)  # the unsigned form of a score of 0


def _unsigned(scores: np.ndarray) -> np.ndarray:
    """Longs as unsigned longs in the same order."""
    return scores.view(np.uint64) ^ ZERO


def _wide(a: np.ndarray, b: np.ndarray, own: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Products whose terms may pass 2**53."""
    near = np.abs(a.astype(np.float64) @ b.T.astype(np.float64))
    for r, c in zip(*np.nonzero((near > 2.0**63 * (1 - 1e-9)) & ~own)):
        exact = sum(int(x) * int(y) for x, y in zip(a[r], b[c]))
        if not -(2**63) < exact < 2**63:
            raise ValueError(f"the score of {q[r]} and {v[c]} does not fit a long")
    return a @ b.T  # modulo 2**64, and so right for all that fit


def _pair(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, vector ids, scores as unsigned (own id: 0, below any score)."""
    q, v = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
    a = np.frombuffer(row["q_ints"], np.int64).reshape(len(q), -1)
    b = np.frombuffer(row["ints"], np.int64).reshape(len(v), -1)
    own = q[:, None] == v[None, :]
    if row["q_top"] * row["top"] * a.shape[1] < 2**53:
        s = (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    else:
        s = _wide(a, b, own, q, v)
    s = _unsigned(s)
    s[own] = 0
    return q, v, s


def _histogram(batches: Iterator[pa.RecordBatch], k: int, bins: int) -> Iterator[pa.RecordBatch]:
    """ranges: per block of queries the low end and the bin width of each query."""
    for b in batches:
        for row in b.to_pylist():
            q, _, s = _pair(row)
            low, width = np.frombuffer(row["low"], np.uint64), np.frombuffer(row["width"], np.uint64)
            out_q, out_bin, out_n = [], [], []
            top = np.sort(np.partition(s, -k, axis=1)[:, -k:], axis=1) if s.shape[1] > k else np.sort(s, axis=1)
            floor = np.maximum(top[:, 0], low)
            r, c = np.nonzero((s >= floor[:, None]) & (s > 0))
            cell = r * (bins + 1) + np.minimum((s[r, c] - low[r]) // width[r], np.uint64(bins)).astype(np.int64)  # the last: above the range
            at, n = np.unique(cell, return_counts=True)
            out_q, out_bin, out_n = q[at // (bins + 1)], at % (bins + 1), n
            yield pa.RecordBatch.from_arrays([pa.array(out_q), pa.array(out_bin, pa.int64()), pa.array(out_n, pa.int64())], names=["query_id", "bin", "n"])


def _above(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Scores over the k-th value, and of those equal to it the k smallest ids."""
    for b in batches:
        for row in b.to_pylist():
            q, v, s = _pair(row)
            kth = np.frombuffer(row["low"], np.uint64)
            r, c = np.nonzero((s >= kth[:, None]) & (s > 0))
            order = np.lexsort((v[c], ~s[r, c], r))
            r, c = r[order], c[order]
            nr = np.arange(len(r)) - np.searchsorted(r, r)
            r, c = r[nr < k], c[nr < k]
            yield pa.RecordBatch.from_arrays([pa.array(q[r]), pa.array(v[c]), pa.array((s[r, c] ^ ZERO).view(np.int64))], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, block: int = BLOCK, bins: int = BINS) -> DataFrame:
    """The k highest scores of each query: query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession
    ship(spark)
    kind = "dim int, n int, top long, ids binary, ints binary"
    chosen = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("ask"))
    blocks = keep(chosen.select("id", "v").mapInArrow(lambda it: _blocks(it, scale, block), kind), "vector-blocks")
    asked = chosen.filter("ask").groupBy("id").agg(F.min("v").alias("v"))
    queries = keep(asked.mapInArrow(lambda it: _blocks(it, scale, block), kind).withColumn("q_nr", F.monotonically_increasing_id()), "query-blocks")

    numbers = queries.select("q_nr", F.col("dim").alias("q_dim"))
    pairs_of = blocks.join(numbers, F.col("dim") == F.col("q_dim")).drop("q_dim")

    def paired(ranges: DataFrame) -> DataFrame:
        q = queries.select("q_nr", F.col("ids").alias("q_ids"), F.col("ints").alias("q_ints"), F.col("top").alias("q_top")).join(ranges, "q_nr")
        return pairs_of.join(q, "q_nr").select("ids", "ints", "top", "q_ids", "q_ints", "q_top", "low", "width", "q_nr")

    most = blocks.groupBy("dim").agg(F.max("top").alias("m")).join(queries, "dim").select("q_nr", "n", F.col("dim"), F.col("m"), "top")
    state = most.mapInPandas(lambda it: _first(it, bins), "q_nr long, low binary, width binary, steps int")
    state = keep(state, "ranges")
    for _ in range(state.agg(F.max("steps")).first()[0] or 0):
        counts = paired(state).mapInArrow(lambda it: _histogram(it, k, bins), "query_id long, bin long, n long")
        counts = counts.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        found = (
            counts.withColumn("over", F.sum("n").over(down))
            .groupBy("query_id").agg(F.max(F.when(F.col("over") >= k, F.col("bin"))).alias("bin"), F.sum("n").alias("n"))
        )
        holders = queries.join(state, "q_nr").mapInPandas(_spread, "q_nr long, at int, query_id long, low string, width string, steps int")
        narrowed = holders.join(found, "query_id", "left").groupBy("q_nr").agg(
            F.sort_array(F.collect_list(F.struct("at", "low", "width", "bin"))).alias("rows"), F.max("steps").alias("steps")
        )
        state = keep(narrowed.mapInPandas(lambda it: _narrow(it, bins), "q_nr long, low binary, width binary, steps int"), "ranges")
    best = paired(state).mapInArrow(lambda it: _above(it, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _first(frames, bins: int):
    """The first range of every query: all possible scores."""
    for df in frames:
        rows = []
        for nr, n, dim, m, top in zip(df["q_nr"], df["n"], df["dim"], df["m"], df["top"]):
            high, width, steps = min(int(m) * int(top) * int(dim), 2**63 - 1), 1, 1  # scores are longs
            while width * bins < 2 * high + 1:
                width, steps = width * bins, steps + 1
            rows.append((nr, np.full(n, 2**63 - high, np.uint64).tobytes(), np.full(n, min(width, 2**63), np.uint64).tobytes(), steps))
        yield type(df)(rows, columns=["q_nr", "low", "width", "steps"])


def _spread(frames):
    for df in frames:
        rows = []
        for r in df.itertuples():
            ids, (low, width) = np.frombuffer(r.ids, np.int64), (np.frombuffer(x, np.uint64) for x in (r.low, r.width))
            rows += [(r.q_nr, i, int(q), str(a), str(w), r.steps) for i, (q, a, w) in enumerate(zip(ids, low, width))]
        yield type(df)(rows, columns=["q_nr", "at", "query_id", "low", "width", "steps"])


def _narrow(frames, bins: int):
    """The bin of the k-th score becomes the range; a query with fewer than k
    scores, or whose k-th is fixed, keeps the low end."""
    for df in frames:
        rows = []
        for r in df.itertuples():
            low, width = [], []
            for x in r.rows:
                b = x["bin"]
                found = b is not None and b == b and b < bins
                low.append(int(x["low"]) + (int(b) * int(x["width"]) if found else 0))
                width.append(max(1, int(x["width"]) // bins))
            rows.append((r.q_nr, np.asarray(low, np.uint64).tobytes(), np.asarray(width, np.uint64).tobytes(), r.steps))
        yield type(df)(rows, columns=["q_nr", "low", "width", "steps"])
