"""Queries over file listings and materialisation logs: manifests, cursors,
months to rebuild, missing days, stale partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import joins as J
from ..plans import incremental as IN
from ..sources import manifests as M
from ..sources import testdata as TD
from .registry import register

_NGED_RE = "^aggregated-smart-meter-data-lv-feeder-\\d{4}-\\d{2}-part\\d{4}\\.csv"
_NAME = "regexp_extract(url, '[^/]*$', 0)"


def ssen_manifest(spark: SparkSession, sf: str) -> DataFrame:
    objects = TD.view(spark, sf, "ssen_listing").select(F.col("url").alias("downloadLink"), "storage_id")
    return M.manifest_from_ssen_objects(objects).drop("created")


def nged_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return M.manifest_from_nged_resources(TD.view(spark, sf, "nged_listing"), created_type="timestamp_ntz")


def _with(*extra: str) -> str:
    return TD.duck_with("ssen_listing", "nged_listing").rstrip("\n") + f""",
ssen_manifest AS (SELECT {_NAME} AS filename, url, storage_id FROM ssen_listing),
nged_manifest AS (SELECT * FROM (SELECT {_NAME} AS filename, url, created FROM nged_listing) WHERE regexp_matches(filename, '{_NGED_RE}'))
""" + "".join(extra)


@register("ssen_manifest", "SC9, PR15", _with() + "SELECT filename, url FROM ssen_manifest")
def ssen_manifest_q(spark, sf):
    return ssen_manifest(spark, sf)


@register("nged_manifest", "SC10, PR15", _with() + "SELECT filename, url, created FROM nged_manifest")
def nged_manifest_q(spark, sf):
    return nged_manifest(spark, sf)


@register(
    "listing_months",
    "PR16",
    _with()
    + "SELECT url, CAST(substr(filename, 1, 7) || '-01' AS DATE) AS month FROM ssen_manifest UNION ALL "
    "SELECT url, CAST(string_split(filename, '-')[7] || '-' || substr(string_split(filename, '-')[8], 1, 2) || '-01' AS DATE) AS month FROM nged_manifest",
)
def listing_months(spark, sf):
    s = ssen_manifest(spark, sf).select("url", C.month_from_url("url", "SSEN").alias("month"))
    n = nged_manifest(spark, sf).select("url", C.month_from_url("url", "NGED").alias("month"))
    return s.unionByName(n)


_NAME_CURSOR = "2000-06-30.csv"


@register("new_files", "IN1", _with() + f"SELECT filename, url FROM ssen_manifest WHERE filename > '{_NAME_CURSOR}'")
def new_files(spark, sf):
    return IN.new_files_by_name(ssen_manifest(spark, sf), _NAME_CURSOR).select("filename", "url")


_CREATED_CURSOR = "2001-01-01 00:00:00"


@register(
    "new_files_by_created",
    "IN2",
    _with() + f"SELECT filename, url, created FROM nged_manifest WHERE created > TIMESTAMP '{_CREATED_CURSOR}'",
)
def new_files_by_created(spark, sf):
    return IN.new_files_by_created(nged_manifest(spark, sf), _CREATED_CURSOR)


@register("latest_file", "AG14", _with() + "SELECT max(created) AS max_created, max(filename) AS max_filename FROM nged_manifest")
def latest_file(spark, sf):
    return A.latest_file(nged_manifest(spark, sf))


_LOG_CURSOR = 7500


@register(
    "affected_months",
    "IN3, PR16",
    _with() + f"SELECT DISTINCT CAST(substr(filename, 1, 7) || '-01' AS DATE) AS month FROM ssen_manifest WHERE storage_id > {_LOG_CURSOR}",
)
def affected_months(spark, sf):
    return IN.affected_months(TD.view(spark, sf, "ssen_listing"), "SSEN", _LOG_CURSOR)


@register(
    "unseen_files",
    "JN8",
    _with()
    + f"SELECT filename, url FROM ssen_manifest WHERE filename NOT IN (SELECT filename FROM ssen_manifest WHERE storage_id <= {_LOG_CURSOR})",
)
def unseen_files(spark, sf):
    man = ssen_manifest(spark, sf)
    ingested = TD.view(spark, sf, "ssen_listing").where(F.col("storage_id") <= _LOG_CURSOR).select(C.filename_from_url("url").alias("filename"))
    return J.unseen_files(man.select("filename", "url"), ingested)


@register(
    "missing_days",
    "SC13",
    _with()
    + """, months AS (SELECT DISTINCT CAST(substr(filename, 1, 7) || '-01' AS DATE) AS month FROM ssen_manifest),
cal AS (SELECT m.month, CAST(g.d AS DATE) AS day FROM months m, generate_series(m.month, last_day(m.month), INTERVAL 1 DAY) AS g(d))
SELECT month, day, strftime(day, '%Y-%m-%d') || '.csv.gz' AS filename FROM cal
WHERE strftime(day, '%Y-%m-%d') || '.csv' NOT IN (SELECT filename FROM ssen_manifest)""",
)
def missing_days(spark, sf):
    man = ssen_manifest(spark, sf)
    months = man.select(C.month_from_url("url", "SSEN").alias("month")).distinct()
    return M.missing_daily_files(months, man)


_PART_MONTH = "1998-03-01"


@register(
    "part_files",
    "SC14",
    _with()
    + "SELECT DISTINCT filename FROM nged_manifest WHERE CAST(string_split(filename, '-')[7] || '-' || substr(string_split(filename, '-')[8], 1, 2) || '-01' AS DATE) "
    f"= DATE '{_PART_MONTH}'",
)
def part_files(spark, sf):
    return M.part_files_for_month(nged_manifest(spark, sf), _PART_MONTH, "NGED")


_SOURCE_CURSOR = "2001-06-01 00:00:00"


@register(
    "changed_sources",
    "IN4",
    "SELECT o_orderpriority AS id, max(o_orderdate) AS last_modified FROM orders GROUP BY 1 "
    f"HAVING o_orderpriority NOT IN ('1-URGENT', '2-HIGH') OR max(o_orderdate) > TIMESTAMP '{_SOURCE_CURSOR}'",
)
def changed_sources(spark, sf):
    resources = TD.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("id")).agg(F.max("o_orderdate").alias("last_modified"))
    cursors = spark.createDataFrame([("1-URGENT", _SOURCE_CURSOR), ("2-HIGH", _SOURCE_CURSOR)], "id string, cursor string").select(
        "id", F.col("cursor").cast("timestamp_ntz").alias("cursor")
    )
    return IN.changed_sources(resources, cursors)


@register(
    "stale_partitions",
    "IN5, SC13",
    _with()
    + """, ins AS (SELECT CAST(substr(filename, 1, 7) || '-01' AS DATE) AS month, 'ssen_files' AS asset, filename AS input_partition,
  max(CAST(substr(filename, 1, 10) AS TIMESTAMP)) AS updated_at FROM ssen_manifest GROUP BY ALL),
outs AS (SELECT DISTINCT month, CAST(month + CAST((month(month) * 7) % 31 AS INTEGER) AS TIMESTAMP) AS built_at FROM ins),
req AS (SELECT m.month, 'ssen_files' AS asset, strftime(CAST(g.d AS DATE), '%Y-%m-%d') || '.csv' AS input_partition
  FROM (SELECT DISTINCT month FROM ins) m, generate_series(m.month, last_day(m.month), INTERVAL 1 DAY) AS g(d)),
newest AS (SELECT month, max(updated_at) AS newest_input FROM ins GROUP BY month),
missing AS (SELECT DISTINCT month FROM req WHERE (month, asset, input_partition) NOT IN (SELECT (month, asset, input_partition) FROM ins))
SELECT n.month, n.newest_input, o.built_at FROM newest n LEFT JOIN outs o USING (month)
WHERE (o.built_at IS NULL OR n.newest_input > o.built_at) AND n.month NOT IN (SELECT month FROM missing)""",
)
def stale_partitions(spark, sf):
    man = ssen_manifest(spark, sf)
    ins = man.select(
        C.month_from_url("url", "SSEN").alias("month"),
        F.lit("ssen_files").alias("asset"),
        F.col("filename").alias("input_partition"),
        F.substring("filename", 1, 10).cast("date").cast("timestamp_ntz").alias("updated_at"),
    ).groupBy("month", "asset", "input_partition").agg(F.max("updated_at").alias("updated_at"))
    months = ins.select("month").distinct()
    outs = months.select("month", F.date_add("month", (F.month("month") * 7) % 31).cast("timestamp_ntz").alias("built_at"))
    req = M.expected_daily_files(months).select(
        "month", F.lit("ssen_files").alias("asset"), F.regexp_replace("filename", r"\.gz$", "").alias("input_partition")
    )
    return IN.stale_partitions(ins, outs, req, key="month")
