"""Month statistics kept while files arrive (AG1 across batches).

Each raw file leaves a state: per month and kind of key, how many rows it has
and which keys, as bitmaps over the numbers a dictionary gives the keys. States
of a month's files merge (counts add, bitmaps are or-ed), so its figures follow
from states alone; no row is read again. A file that lands anew replaces its own
state. Sets are exact, whatever their size: a bitmap covers 32,768 numbers, and
a state has as many as its keys need.

  <root>/dictionary/          kind, key, id: only ever added to
  <root>/states/file=<name>/  month, kind, bucket, keys (bitmap), n_rows

Updates of one root run one after another. One that fails may leave numbers that
no state uses, and is repeated.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_table

DICTIONARY = "kind string, key string, id long"
STATES = "month date, kind string, bucket long, keys binary, n_rows long, file string"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # the first update
        return spark.createDataFrame([], schema)


def update_stats(spark: SparkSession, root: str, rows: DataFrame, keys: dict[str, Column], files: list[str] | None = None, file_col: str = "source_file", month_col: str = "month") -> None:
    """Put in the states of the files whose ``rows`` these are. ``keys``: what to
    count distinctly, by kind; a null key counts as one (N6). ``files``: all
    files of the batch, so that one which has no rows any more loses its state."""
    root = root.rstrip("/")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in keys.items()])
    # a row per file, month and key: all later steps work on these
    counted = scratch_table(
        rows.select(F.col(file_col).alias("file"), F.col(month_col).cast("date").alias("month"), F.explode(kinds).alias("k"))
        .groupBy("file", "month", "k.kind", "k.key").agg(F.count(F.lit(1)).alias("n_rows")),
        "file-keys",
    )
    known = _stored(spark, f"{root}/dictionary", DICTIONARY)
    fresh = counted.where("key IS NOT NULL").select("kind", "key").distinct().join(known, ["kind", "key"], "left_anti")
    # 0 stands for null; numbers are dense within a task, so bitmaps are full
    first = (known.agg(F.max("id")).first()[0] or 0) + 1
    fresh.select("kind", "key", (F.monotonically_increasing_id() + first).alias("id")).write.mode("append").parquet(f"{root}/dictionary")
    numbers = _stored(spark, f"{root}/dictionary", DICTIONARY)
    told = counted.join(numbers, ["kind", "key"], "left").withColumn("id", F.when(F.col("key").isNull(), F.lit(0).cast("long")).otherwise(F.col("id")))
    states = told.groupBy("file", "month", "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("keys"), F.sum("n_rows").alias("n_rows")
    )
    if files:  # a state without rows, in place of an earlier one
        blank = spark.createDataFrame([(f,) for f in files], "file string").selectExpr("file", "CAST(NULL AS DATE) AS month", "'' AS kind", "-1L AS bucket", "CAST(NULL AS BINARY) AS keys", "0L AS n_rows")
        states = states.unionByName(blank)
    out = states.select("month", "kind", "bucket", "keys", "n_rows", "file").hint("rebalance", "file")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").parquet(f"{root}/states")


def month_stats(spark: SparkSession, root: str, kinds: list[str]) -> DataFrame:
    """month, row_count, nunique_<kind> for each kind, from the states."""
    states = _stored(spark, f"{root.rstrip('/')}/states", STATES).where("kind <> ''")
    merged = states.groupBy("month", "kind", "bucket").agg(F.sum("n_rows").alias("n_rows"), F.bitmap_count(F.bitmap_or_agg("keys")).alias("n_keys"))
    aggs = [F.sum(F.when(F.col("kind") == kinds[0], F.col("n_rows"))).alias("row_count")]
    aggs += [F.sum(F.when(F.col("kind") == k, F.col("n_keys"))).alias(f"nunique_{k}") for k in kinds]
    return merged.groupBy("month").agg(*aggs)
