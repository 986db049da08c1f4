"""Parquet and CSV sinks (SK1, SK3, SK4, SK5) and the GeoParquet entry (SK2).

Month tables are written partitioned by ``month`` (and ``dno`` for staging)
with dynamic partition overwrite: a job replaces exactly the month folders
it produces, a month without rows is not written at all, and rerunning a
failed job rewrites the same folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.timefns import month_start
from ..operators.ordering import day_sorted_for_write, range_sorted_for_write, space_sorted_for_write


#: the ``dno`` folder of rows set aside: no reader of a DNO's months meets them
ASIDE_SUFFIX = "-ASIDE"


def write_staging(df: DataFrame, root: str, dno: str, partitions: int | None = None, order: str = "daily", aside: str | None = None) -> None:
    """Sorted staging months under ``root/dno=<DNO>/month=<YYYY-MM-01>/`` (SK1, SK5).

    A ``month`` column set by the caller (the file's month) is kept; otherwise
    the reading's month is used. ``order="daily"`` (default) writes sorted
    one-day files in one pass; ``"global"`` range-sorts the whole month
    (file names follow the order) at the cost of a sampling pass. ``aside``
    names a boolean column: its rows go, in the same write, to months of their
    own under ``dno=<DNO>-ASIDE``.
    """
    name = F.lit(dno.upper())
    out = df.withColumn("dno", F.concat(name, F.when(F.col(aside), F.lit(ASIDE_SUFFIX)).otherwise(F.lit("")))).drop(aside) if aside else df.withColumn("dno", name)
    if "month" not in out.columns:
        out = out.withColumn("month", month_start("data_collection_log_timestamp"))
    if order == "global":
        ordered = range_sorted_for_write(out, S.STAGING_SORT, partition_col="month", n=partitions)
    else:
        ordered = day_sorted_for_write(out, S.STAGING_SORT, folders=["dno"] if aside else None)
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dno", "month")
        .parquet(root)
    )


def write_published(
    df: DataFrame, root: str, partitions: int | None = None, geoparquet: bool = True, order: str = "global"
) -> None:
    """The published table, sorted, one folder per month (SK2).

    ``order="global"`` (default, as published) range-sorts each month so file
    names follow the order; ``"daily"`` writes sorted one-day files in one
    pass; ``"space"`` puts neighbouring places into the same files, for reads by
    box. With ``geoparquet`` the files carry the ``geo`` footer and an index
    names them (Python Data Source writer; read with ``read_published``), and
    files that no index has named for a day are swept; otherwise Spark's writer
    with zstd is used.
    """
    out = df.withColumn("month", month_start("data_collection_log_timestamp"))
    if order == "global":
        ordered = range_sorted_for_write(out, S.PUBLISHED_SORT, partition_col="month", n=partitions)
    elif order == "space":
        ordered = space_sorted_for_write(out, S.PUBLISHED_SORT, n=partitions)
    else:
        ordered = day_sorted_for_write(out, S.PUBLISHED_SORT)
    if geoparquet:
        import os
        import re

        from .geoparquet import register, sweep

        # the file writer runs pyarrow on the executors: give it an absolute
        # path (or keep the URI) rather than one relative to the driver's folder
        if not re.match(r"[A-Za-z][\w+.-]*:/", root) and not os.path.isabs(root):
            root = os.path.abspath(root)
        register(df.sparkSession)
        (
            ordered.write.format("meterflow_geoparquet")
            .mode("append")
            .option("path", root)
            .option("partition", "month")
            .option("sort", ",".join(S.PUBLISHED_SORT))
            .save()
        )
        sweep(root)
        return
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("month")
        .parquet(root)
    )


def write_location_lookup(df: DataFrame, path: str) -> None:
    """Two-column lookup table (SK3)."""
    df.select(*S.LOOKUP_COLUMNS).write.mode("overwrite").parquet(path)


def write_csv_extract(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV extract with a chosen column order (SK4)."""
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def clear_month(spark, root: str, month: str, dno: str | None = None) -> None:
    """Empty one month folder explicitly (SK5: a month whose input vanished).

    Writes an empty frame over the folder with static overwrite, so the
    month stays present but holds no rows.
    """
    folder = f"{root.rstrip('/')}/" + (f"dno={dno.upper()}/" if dno else "") + f"month={month}"
    empty = spark.read.parquet(folder).limit(0)  # the table's own schema
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
