"""What several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_table

_SHIPPED: set[str] = set()


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound what Spark hands a Python worker at once by bytes (64 MB otherwise):
    for work that carries whole rows, of which worker and JVM hold copies."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (as ``--py-files``
    would), once per application, so that functions are imported there and
    a worker's caches outlive a task."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="meterflow-ship-"), "meterflow_llm.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join(os.path.basename(root), os.path.relpath(full, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there."""
    return scratch_table(df, name)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def same(a: Column, b: Column) -> Column:
    """Equality in which nulls are equal; an equi-join key for Spark."""
    return a.eqNullSafe(b)


def add_columns(docs: DataFrame, made: DataFrame, key: str, names: list[str]) -> DataFrame:
    """``docs`` with columns of ``made`` (one row per key at most), which
    replace columns of the same name. Null keys match null keys."""
    right = made.select(F.col(key).alias("__key"), *[F.col(n).alias(f"__new_{n}") for n in names])
    joined = docs.join(right, same(docs[key], right["__key"]), "left").drop("__key")
    kept = [joined[c] for c in docs.columns if c not in names]
    return joined.select(*kept, *[joined[f"__new_{n}"].alias(n) for n in names])


ID_BITS = 1 << 23


def packed_text(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(id, text) as (id, size, body): zstd, about half of what a shuffle's own codec leaves."""
    texts = [t.as_py() or b"" for t in batch.column(1).cast(pa.binary())]
    cols = [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([pa.compress(t, "zstd", asbytes=True) if t else b"" for t in texts], pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["id", "size", "body"])


def unpacked_text(size: int, body: bytes) -> bytes:
    return pa.decompress(body, size, "zstd", asbytes=True) if size else b""


def with_ids(docs: DataFrame, ids: DataFrame, packed: bool = False) -> DataFrame:
    """``docs`` (a long ``id`` and a text) less most rows whose id is not in
    ``ids``: a map-side filter by a bitmap of ``ID_BITS`` id hashes, 2**18 rows
    on the driver at most. Rows of other ids may stay, so a join must follow;
    what it saves is shuffling texts that the join would drop. ``packed``: the
    texts as ``packed_text`` has them."""
    at = F.pmod(F.xxhash64("id"), F.lit(ID_BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(32)).cast("int"))
    rows = ids.select(F.floor(at / 32).alias("w"), one.alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(ID_BITS // 32, np.int64)
    bits[rows["w"].to_numpy()] = rows["bits"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def picked(batches):
        for b in batches:
            h = b.column(2).to_numpy()
            some = b.filter(pa.array((sent.value[h // 32] >> (h % 32)) & 1 == 1)).select([0, 1])
            yield packed_text(some) if packed else some

    if packed:
        return docs.withColumn("__at", at).mapInArrow(picked, "id long, size long, body binary")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.withColumn("__at", at).mapInArrow(picked, kind)
