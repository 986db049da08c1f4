"""Line dedup by levelled sorted runs of line hashes.

A line's key is the line with ASCII white space stripped at both ends and A-Z
lower-cased; it is known by a 128-bit hash. Lines of fewer than ``min_chars``
code points are never touched. Documents come in batches of descending id.
Each new batch is reduced to one row per key and merge-anti-joined with the
runs: keys in no run are new and become a run of their own (bucketed and
sorted by the hash, so later merges neither shuffle nor sort it); keys that
are known go to a log of repeats. When a level holds ``fan_in`` runs they are
merged into one run of the next level. Every key therefore stands in exactly
one run, with the largest document id that holds it (the batches descend),
and runs plus repeats give the number of documents holding it.

A key found in at least ``min_docs`` documents loses its lines everywhere but
in the largest document id that holds it.

Defined results: a null text is an empty one (one empty line). Rows that share
an id count as documents of their own, and all of them hold that id. A null id is an id of its own, smaller than all
others. Added columns replace input columns of the same name; other columns
pass through. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, same, shared_path, ship, small_batches
from .tokens import trimmed

BLANK = b" \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]


def _key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a lower-cased line's key, or None if the key is too short."""
    line = line.strip(BLANK)
    if len(line) < min_chars or (len(line) < 4 * min_chars and len(line.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(line)


def _keys(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, cuts, found = b.column(0), [], []
        for i, t in enumerate(b.column(1)):
            lines = (t.as_py() or "").encode().lower().split(b"\n")
            own = {k for x in lines if (k := _key(x, min_chars)) is not None}
            found.extend(own)
            cuts.extend([i] * len(own))
        halves = np.frombuffer(b"".join(found), ">i8").astype(np.int64).reshape(-1, 2)
        columns = [ids.take(pa.array(cuts, pa.int64())), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "h1", "h2"])


def _rebuild(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Columns: text, hashes of the keys to drop. Adds the results."""
    for b in batches:
        at = {n: k for k, n in enumerate(b.schema.names)}
        n_lines, n_dropped, texts, shas = [], [], [], []
        for t, d in zip(b.column(at["__text"]), b.column(at["__drop"])):
            text, drop = t.as_py() or "", d.as_py()
            raw = text.encode()
            lines = raw.split(b"\n")
            if drop:
                gone = set(drop)
                kept = [x for x in lines if (k := _key(x.lower(), min_chars)) is None or k not in gone]
                raw = b"\n".join(kept)
                n_dropped.append(len(lines) - len(kept))
            else:
                n_dropped.append(0)
            n_lines.append(len(lines))
            texts.append(raw.decode())
            shas.append(hashlib.sha256(raw).hexdigest())
        rest = [b.column(k) for k, n in enumerate(b.schema.names) if n not in ("__text", "__drop")]
        names = [n for n in b.schema.names if n not in ("__text", "__drop")]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(shas, pa.string())],
            names=[*names, "__kept", "__n_lines", "__n_dropped", "__sha"],
        )


class LineRuns:
    """Levelled runs of line keys (h1, h2, n_docs, keeper), each a table
    bucketed and sorted by (h1, h2) in the shared folder."""

    def __init__(self, spark: SparkSession, fan_in: int, buckets: int):
        self.spark, self.fan_in, self.buckets = spark, fan_in, buckets
        self.levels: list[list[str]] = []
        self.repeats: list[DataFrame] = []

    def _write(self, df: DataFrame) -> str:
        path = shared_path(self.spark, "line-run")
        name = path.rsplit("/", 1)[1].replace("-", "_")
        (
            df.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
            .option("path", path).format("parquet").saveAsTable(name)
        )
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(n) for level in self.levels for n in level]

    def add(self, batch: DataFrame) -> None:
        """Merge a batch (h1, h2, n_docs, keeper) of smaller ids than all before."""
        batch = keep(batch, "line-batch") if self.levels else batch
        new = batch
        for run in self.runs():
            new = new.join(run.hint("merge"), KEY, "left_anti")
            self.repeats.append(batch.join(run.hint("merge"), KEY, "left_semi").select(*KEY, "n_docs"))
        self._put(0, self._write(new))

    def _put(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_in:
            merged = self.spark.table(self.levels[level][0])
            for n in self.levels[level][1:]:
                merged = merged.unionAll(self.spark.table(n))
            self.levels[level] = []
            self._put(level + 1, self._write(merged))

    def counted(self, min_docs: int) -> DataFrame:
        """(h1, h2, keeper) of the keys held by at least ``min_docs`` documents."""
        runs = self.runs()
        if not self.repeats:
            return runs[0].filter(F.col("n_docs") >= min_docs).select(*KEY, "keeper")
        again = self.repeats[0]
        for r in self.repeats[1:]:
            again = again.unionAll(r)
        again = keep(again.groupBy(*KEY).agg(F.sum("n_docs").alias("more")), "line-repeats")
        out = None
        for run in runs:
            got = (
                run.join(again, KEY, "left")
                .filter(F.col("n_docs") + F.coalesce("more", F.lit(0)) >= min_docs)
                .select(*KEY, "keeper")
            )
            out = got if out is None else out.unionAll(got)
        return out


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fan_in: int = 3,
    columns: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the repeated lines out of ``text_col``, and n_lines (before),
    n_dropped and kept_sha256 (hex, UTF-8). ``columns``: those to keep (all)."""
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    only = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    lines = only.mapInArrow(trimmed(lambda it: _keys(it, min_chars)), f"id {kind}, h1 long, h2 long")
    bounds = [b for b in (docs.select(F.percentile_approx(id_col, [i / batches for i in range(1, batches)], 1000)).first()[0] or [])] if batches > 1 else []
    step = F.lit(len(bounds))
    for b in bounds:  # 0 is the batch of the largest ids
        step = step - (F.col("id") > F.lit(b)).cast("int")
    step = F.when(F.col("id").isNull(), F.lit(len(bounds))).otherwise(step)
    path = shared_path(spark, "line-keys")
    lines.withColumn("batch", step).write.partitionBy("batch").parquet(path)
    stored = spark.read.schema(f"id {kind}, h1 long, h2 long, batch int").parquet(path)

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = LineRuns(spark, fan_in, buckets)
    for i in range(len(bounds) + 1):
        part = stored.filter(F.col("batch") == i).groupBy(*KEY)
        runs.add(part.agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper")))
    hot = keep(runs.counted(min_docs), "line-hot")

    drop = (
        stored.join(hot, KEY)
        .filter(~same(F.col("id"), F.col("keeper")))
        .select("id", F.concat(*[F.unhex(F.lpad(F.hex(k), 16, "0")) for k in KEY]).alias("k"))
        .groupBy(F.col("id").alias("__of")).agg(F.collect_set("k").alias("__drop"))
    )
    names = ["n_lines", "n_dropped", "kept_sha256"]
    wanted = [c for c in (columns or docs.columns) if c not in names and c != text_col]
    left = docs.select(*wanted, F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    joined = left.join(drop, same(F.col("__id"), F.col("__of")), "left").drop("__of", "__id")
    made = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in wanted), "__kept string, __n_lines long, __n_dropped long, __sha string"])
    out = joined.mapInArrow(trimmed(lambda it: _rebuild(it, min_chars)), made)
    order = [c for c in (columns or docs.columns) if c not in names]
    pick = {text_col: F.col("__kept").alias(text_col)}
    return out.select(*[pick.get(c, F.col(f"`{c}`")) for c in order], F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.col("__sha").alias("kept_sha256"))
