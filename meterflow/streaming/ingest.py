"""File-stream ingest (IN6) and in-stream de-duplication (IN8).

``ingest_stream`` replaces the reference's sensors: a Structured Streaming
file source sees only files it has not processed (its checkpoint is the
cursor), and each micro-batch rebuilds the months those files touch, by
re-reading every landed file of those months and writing the month folders
with dynamic partition overwrite. A rerun after a failure repeats the same
writes, so batches are idempotent; the checkpoint lives in the shared
folder from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import month_from_nged_url, month_from_ssen_url
from ..functions.timefns import month_start
from ..operators import windows as W
from ..session import checkpoint_dir
from ..sources import csvfiles as CSV

TS = "data_collection_log_timestamp"


def scratch_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """(checkpoint, output) folders for one run under the shared checkpoint dir."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:
        app = "session"
    base = checkpoint_dir(spark).rstrip("/") + f"/meterflow-scratch-{app}/{name}-{uuid.uuid4().hex}"
    return base + "/checkpoint", base + "/output"


def run_available(
    stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, name: str | None = None
) -> None:
    """Process everything available now, then stop (a scheduled batch run)."""
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    query = writer.start()
    query.awaitTermination()


def ingest_stream(
    spark: SparkSession,
    landing_dir: str,
    rebuild_months: Callable[[list[str]], None],
    checkpoint: str | None = None,
    month_of_file: Callable | None = None,
    glob: str = "*.csv*",
) -> None:
    """New raw CSV files -> months to rebuild -> ``rebuild_months(months)`` (IN6).

    As the sensors do, a file counts for the month in its name (SSEN day file or
    NGED part file, or what ``month_of_file`` makes of its path); one without is
    read for the months of its readings, its timestamp column found by its own
    header. What a batch brings to the driver is the names of such files and its
    distinct months, the same decision the reference's sensor makes.
    """
    chk = checkpoint or scratch_paths(spark, "ingest")[0]
    lines = spark.readStream.option("pathGlobFilter", glob).text(landing_dir).select(F.col("_metadata.file_path").alias("source_file"))

    def on_batch(batch: DataFrame, _epoch: int) -> None:
        path = F.col("source_file")
        month = month_of_file(path) if month_of_file is not None else F.coalesce(month_from_ssen_url(path), month_from_nged_url(path))
        named = batch.select(month.alias("month"), F.when(month.isNull(), path).alias("file")).distinct().collect()
        months = {str(r["month"]) for r in named if r["month"] is not None}
        unnamed = [CSV.literal_path(r["file"]) for r in named if r["month"] is None]
        if unnamed and month_of_file is None:
            read = CSV.read_csv(batch.sparkSession, unnamed, [TS]).select(month_start(F.col(TS).cast("timestamp")).alias("month"))
            months |= {str(r["month"]) for r in read.where("month IS NOT NULL").distinct().collect()}
        if months:
            rebuild_months(sorted(months))

    run_available(lines, on_batch, chk)


DAY = "__day"
COMPACT_AFTER = 32


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave a checkpoint's query when it was first started; another
    checkpoint, or a new one at the same place, has another."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def dedupe_stream(stream: DataFrame, keys: list[str], output: str, checkpoint: str, column: str = TS, compact_after: int = COMPACT_AFTER) -> None:
    """One row per ``keys`` (the timestamp ``column`` among them) in ``output``,
    a folder per day, however late a row or its repetition arrives and
    whichever stream brings it (IN8).

    There is no watermark, so nothing is too late. The state is the rows landed
    beside ``output``, by day, then by checkpoint and epoch: streams with
    checkpoints of their own feed one output without touching each other's
    rows, and a retried batch lands on its own rows alone. Repetitions share the
    timestamp, hence the day, so a batch reads the landed rows of its days
    only, de-duplicates them (WN1) and rewrites these days' folders of the
    output: the work follows the days a batch touches, not what is stored. A
    day whose rows came in ``compact_after`` parts gets them in one, without
    repetitions. A write that fails is made good by the retried batch, as the
    landed rows stay. A batch's distinct days come to the driver with the
    metrics of its one write. Streams into one output run one after another.
    """
    if column not in keys:
        raise ValueError(f"{column} must be one of the keys: repetitions are looked for in one day")
    landed = f"{output.rstrip('/')}-landed"
    columns = stream.columns
    schema = T.StructType([*stream.schema.fields, *[T.StructField(c, T.StringType()) for c in (DAY, "source", "epoch")]])
    day = F.coalesce(F.date_format(F.col(column), "yyyy-MM-dd"), F.lit("none"))

    def on_batch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        source = checkpoint_id(spark, checkpoint)
        seen = Observation()
        rows = batch.withColumns({DAY: day, "source": F.lit(source), "epoch": F.lit(str(epoch))})
        _write(rows.observe(seen, F.collect_set(DAY).alias("days")), landed, [DAY, "source", "epoch"])
        days = sorted(seen.get["days"])
        if not days:
            return
        stored = spark.read.schema(schema).option("basePath", landed).parquet(*[f"{landed}/{DAY}={d}" for d in days])
        parts = stored.groupBy(DAY, "source", "epoch").agg(F.lit(1)).groupBy(DAY).agg(F.collect_list(F.struct("source", "epoch")).alias("parts")).collect()
        rows = stored.select(*columns, DAY)
        kept = rows.dropDuplicates() if set(columns) == set(keys) else W.first_by(rows, [*keys, DAY], [])
        _write(kept.hint("rebalance", DAY), output, [DAY])
        many = {r[DAY]: r["parts"] for r in parts if len(r["parts"]) >= compact_after}
        if many:
            _compact(spark.read.schema(schema).parquet(output).where(F.col(DAY).isin(list(many))).select(*columns, DAY), landed, many)

    run_available(stream, on_batch, checkpoint)


def _write(df: DataFrame, path: str, by: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _compact(kept: DataFrame, landed: str, parts: dict) -> None:
    """Days' rows without repetitions as one more part, then the parts they came
    from go. Broken off between the two, repetitions stay, which do no harm."""
    import pyarrow.fs as pafs

    _write(kept.withColumns({"source": F.lit("compacted"), "epoch": F.lit(uuid.uuid4().hex)}), landed, [DAY, "source", "epoch"])
    fs, base = pafs.FileSystem.from_uri(landed)
    for d, gone in parts.items():
        for p in gone:
            fs.delete_dir(f"{base}/{DAY}={d}/source={p['source']}/epoch={p['epoch']}")
