"""Incremental rebuild logic over listing and materialisation tables (IN1-IN5).

The reference drives these with sensors and cursors; here they are plain
DataFrame operations over a listing (manifest) or a log table, so the
decision "which files are new, which months to rebuild" is a Spark job whose
result feeds the month builds (dynamic partition overwrite).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import month_from_url


def new_files_by_name(manifest: DataFrame, cursor: str | None) -> DataFrame:
    """Files whose name sorts after the cursor (IN1); the next cursor is the
    largest name returned (``latest_file``)."""
    if not cursor:
        return manifest.orderBy("filename")
    return manifest.where(F.col("filename") > F.lit(cursor)).orderBy("filename")


def new_files_by_created(manifest: DataFrame, cursor) -> DataFrame:
    """Files created after the cursor; names arrive out of order, so the
    creation time is the cursor (IN2)."""
    if cursor is None:
        return manifest.orderBy("filename")
    typ = manifest.schema["created"].dataType.simpleString()
    return manifest.where(F.col("created") > F.lit(str(cursor)).cast(typ)).orderBy("filename")


def affected_months(log: DataFrame, dno: str, after_id: int | None, url: str = "url", storage_id: str = "storage_id") -> DataFrame:
    """Months to rebuild from log entries after a storage id (IN3). A day
    landed again makes its month appear again."""
    rows = log if after_id is None else log.where(F.col(storage_id) > F.lit(after_id))
    return rows.select(month_from_url(url, dno).alias("month")).where(F.col("month").isNotNull()).distinct().orderBy("month")


def next_cursor(log: DataFrame, after_id: int | None, storage_id: str = "storage_id") -> DataFrame:
    """The storage id the next run starts after (IN3)."""
    rows = log if after_id is None else log.where(F.col(storage_id) > F.lit(after_id))
    return rows.agg(F.max(storage_id).alias("cursor"))


def changed_sources(resources: DataFrame, cursors: DataFrame, key: str = "id") -> DataFrame:
    """Whole-file sources to reload: no cursor yet, or modified after it (IN4)."""
    j = resources.join(cursors, key, "left")
    return j.where(F.col("cursor").isNull() | (F.col("last_modified") > F.col("cursor"))).select(key, "last_modified")


def stale_partitions(
    inputs: DataFrame,
    outputs: DataFrame,
    required: DataFrame | None = None,
    key: str = "partition",
    tolerate_missing: bool = False,
    latest_only: bool = False,
    ignore_assets: list[str] | None = None,
) -> DataFrame:
    """Output partitions to rebuild (IN5).

    ``inputs``: key, asset, input_partition, updated_at[, in_progress];
    ``outputs``: key, built_at (absent = never built); ``required``: key,
    asset, input_partition that must exist. A partition is stale when an
    input is newer than its build (or it was never built) and, unless
    ``tolerate_missing``, no required input is absent; nothing is rebuilt
    while an input is in progress. ``ignore_assets`` leaves those inputs out
    of the newer/missing tests (variant for raw files); ``latest_only``
    keeps only the newest partition.
    """
    ins = inputs
    if ignore_assets:
        ins = ins.where(~F.col("asset").isin(ignore_assets))
    in_progress: Column = F.col("in_progress") if "in_progress" in ins.columns else F.lit(False)
    newest = ins.groupBy(key).agg(
        F.max("updated_at").alias("newest_input"),
        F.max(in_progress.cast("int")).alias("__busy"),
    )
    cand = newest.join(outputs.select(key, "built_at"), key, "left")
    stale = cand.where((F.col("built_at").isNull() | (F.col("newest_input") > F.col("built_at"))) & (F.coalesce(F.col("__busy"), F.lit(0)) == 0))
    if required is not None and not tolerate_missing:
        req = required
        if ignore_assets:
            req = req.where(~F.col("asset").isin(ignore_assets))
        present = ins.select(key, "asset", "input_partition").distinct()
        missing = req.join(present, [key, "asset", "input_partition"], "left_anti").select(key).distinct()
        stale = stale.join(missing, key, "left_anti")
    if latest_only:
        latest = inputs.agg(F.max(key).alias(key))
        stale = stale.join(latest, key, "left_semi")
    return stale.select(key, "newest_input", "built_at")
