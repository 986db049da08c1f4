"""File listings and month calendars (SC9-SC14).

A listing is a small JSON document; it is read by Spark like any other file
so the manifest is a DataFrame that joins against what was already landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import filename_from_url, month_from_url


def _json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def manifest_from_ssen_objects(objects: DataFrame) -> DataFrame:
    """Rows with ``downloadLink`` -> (filename, url, created=null), by filename."""
    return objects.select(
        filename_from_url("downloadLink").alias("filename"),
        F.col("downloadLink").alias("url"),
        F.lit(None).cast("timestamp").alias("created"),
    ).orderBy("filename")


def file_manifest_ssen(spark: SparkSession, path: str) -> DataFrame:
    """SSEN listing ``objects[].downloadLink`` (SC9)."""
    objs = _json(spark, path).select(F.explode("objects").alias("o")).select("o.*")
    return manifest_from_ssen_objects(objs)


def manifest_from_nged_resources(resources: DataFrame, created_type: str = "timestamp") -> DataFrame:
    """Rows with (url, created) -> part files only, created as UTC, by filename."""
    name = filename_from_url("url")
    return (
        resources.select(
            name.alias("filename"),
            F.col("url"),
            F.col("created").cast(created_type).alias("created"),
        )
        .where(F.col("filename").rlike(S.NGED_PART_FILE_PATTERN))
        .orderBy("filename")
    )


def file_manifest_nged(spark: SparkSession, path: str) -> DataFrame:
    """NGED data package ``resources[]`` (SC10)."""
    res = _json(spark, path).select(F.explode("resources").alias("r")).select("r.url", "r.created")
    return manifest_from_nged_resources(res)


def file_manifest_npg(spark: SparkSession, path: str) -> DataFrame:
    """NPg listing: attachments whose ``metas.id`` mentions feeders (SC11)."""
    att = _json(spark, path).select(F.explode("attachments").alias("a"))
    return att.where(F.col("a.metas.id").contains("feeder")).select(F.col("a.href").alias("url"))


def resource_last_modified(spark: SparkSession, path: str, resource_id: str) -> DataFrame:
    """One resource's last_modified as UTC; an absent id is an error (SC12)."""
    res = _json(spark, path).select(F.explode("result.resources").alias("r")).select("r.id", "r.last_modified")
    found = res.where(F.col("id") == resource_id).select(F.col("last_modified").cast("timestamp").alias("last_modified"))
    counted = found.agg(F.max("last_modified").alias("last_modified"), F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.when(F.col("n") == 0, F.raise_error(F.lit(f"Resource {resource_id} not found")))
        .otherwise(F.col("last_modified"))
        .alias("last_modified")
    )


def expected_daily_files(months: DataFrame, month_col: str = "month") -> DataFrame:
    """Calendar of daily file names for each month (SC13)."""
    first = F.trunc(F.col(month_col).cast("date"), "MM")
    return months.select(
        first.alias("month"),
        F.explode(F.sequence(first, F.last_day(first), F.expr("INTERVAL 1 DAY"))).alias("day"),
    ).select("month", "day", F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(".csv.gz")).alias("filename"))


def missing_daily_files(months: DataFrame, manifest: DataFrame, month_col: str = "month") -> DataFrame:
    """Days of the month with no file in the manifest; skipped, not fatal (SC13)."""
    expected = expected_daily_files(months, month_col)
    landed = manifest.select(F.regexp_replace("filename", r"\.gz$", "").alias("name")).distinct()
    return expected.join(
        landed, F.regexp_replace(expected["filename"], r"\.gz$", "") == landed["name"], "left_anti"
    )


def part_files_for_month(manifest: DataFrame, month: str, dno: str = "NGED") -> DataFrame:
    """Manifest rows whose url belongs to the month; distinct, sorted (SC14)."""
    return (
        manifest.where(month_from_url("url", dno) == F.lit(month).cast("date"))
        .select("filename")
        .distinct()
        .orderBy("filename")
    )
