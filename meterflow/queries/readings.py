"""Queries over the readings: staging rules, the published table, filters,
aggregates and windows. Each Spark builder reads the driver's tables through
the meter views; the oracle is the same computation in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import aggregates as A
from ..operators import filters as FI
from ..operators import joins as J
from ..operators import ordering as O
from ..operators import setops as SE
from ..operators import transform as T
from ..operators import windows as W
from ..sources import testdata as TD
from .registry import register

TS = "data_collection_log_timestamp"

# ---------------------------------------------------------------------------
# shared Spark building blocks
# ---------------------------------------------------------------------------


def merged_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return J.merged_location_lookup(TD.view(spark, sf, "lookup_postcodes"), TD.view(spark, sf, "lookup_model"))


def nged_staging(spark: SparkSession, sf: str) -> DataFrame:
    return T.clean_nged(TD.nged_readings(spark, sf))


def ssen_staging(spark: SparkSession, sf: str) -> DataFrame:
    return J.attach_locations(TD.ssen_readings(spark, sf), merged_lookup(spark, sf))


def staging(spark: SparkSession, sf: str) -> DataFrame:
    """Both DNOs' staging rows from one scan of the feed."""
    return T.stage_mixed_feed(TD.readings(spark, sf), merged_lookup(spark, sf))


def published(spark: SparkSession, sf: str) -> DataFrame:
    return T.to_published(staging(spark, sf))


def flat(df: DataFrame) -> DataFrame:
    return T.flatten_geometry(df)


# ---------------------------------------------------------------------------
# shared DuckDB text
# ---------------------------------------------------------------------------

_LOC = "substation_geo_location"
PUBLISHED_CTE = f""",
published AS (SELECT dataset_id, dno_alias,
  CAST(round_even(aggregated_device_count_active, 0) AS BIGINT) AS aggregated_device_count_active,
  CAST(round_even(total_consumption_active_import, 0) AS BIGINT) AS total_consumption_active_import,
  date_trunc('millisecond', data_collection_log_timestamp) AS data_collection_log_timestamp,
  CASE WHEN {_LOC} IS NULL THEN NULL ELSE CAST(trim(substr({_LOC}, strpos({_LOC}, ',') + 1)) AS DOUBLE) END AS longitude,
  CASE WHEN {_LOC} IS NULL THEN NULL ELSE CAST(trim(split_part({_LOC}, ',', 1)) AS DOUBLE) END AS latitude,
  CASE WHEN dno_alias = 'NGED' THEN dno_alias || '-' || secondary_substation_id
       WHEN dno_alias = 'SSEN' THEN dno_alias || '-' || substr(dataset_id, 1, 10) END AS secondary_substation_unique_id,
  CASE WHEN dno_alias = 'NGED' THEN dno_alias || '-' || secondary_substation_id || '-' || lv_feeder_id
       WHEN dno_alias = 'SSEN' THEN dno_alias || '-' || dataset_id END AS lv_feeder_unique_id
FROM staging)
"""


def with_published() -> str:
    return TD.duck_with("staging", "lookup_postcodes", "lookup_model").rstrip("\n") + PUBLISHED_CTE


PUB_COLS = (
    "dataset_id, dno_alias, aggregated_device_count_active, total_consumption_active_import, "
    "data_collection_log_timestamp, longitude, latitude, secondary_substation_unique_id, lv_feeder_unique_id"
)

# ---------------------------------------------------------------------------
# staging rules
# ---------------------------------------------------------------------------


@register("canonical_readings", "PR1, N1", TD.duck_with("readings") + "SELECT * FROM readings")
def canonical_readings(spark, sf):
    return TD.readings(spark, sf)


@register(
    "blank_to_null",
    "PR2, PR3, N2",
    TD.duck_with("nged_readings")
    + "SELECT "
    + ", ".join(
        (f"CASE WHEN {c} IN ({', '.join(repr(t) for t in S.NGED_BLANK_TOKENS)}) THEN NULL ELSE {c} END AS {c}" if c in S.NGED_BLANK_COLUMNS else c)
        for c in S.CANONICAL_COLUMNS
    )
    + " FROM nged_readings",
)
def blank_to_null(spark, sf):
    return T.blank_to_null(TD.nged_readings(spark, sf))


@register("fill_alias", "PR3, PR4", TD.duck_with("nged_staging") + "SELECT * FROM nged_staging")
def fill_alias(spark, sf):
    return nged_staging(spark, sf)


@register(
    "location_lookup_merged",
    "JN1",
    TD.duck_with("merged_lookup") + "SELECT substation_nrn, substation_geo_location FROM merged_lookup",
)
def location_lookup_merged(spark, sf):
    return merged_lookup(spark, sf)


@register("attach_locations", "PR5, JN2, PR6", TD.duck_with("ssen_staging") + "SELECT * FROM ssen_staging")
def attach_locations(spark, sf):
    return ssen_staging(spark, sf)


@register("published_readings", "PR11, PR13, PR14, PR18, PR21", with_published() + f"SELECT {PUB_COLS} FROM published")
def published_readings(spark, sf):
    return flat(published(spark, sf))


@register(
    "combine_dnos",
    "SE1, PR14 per DNO",
    with_published() + "SELECT dno_alias, count(*) AS row_count, CAST(sum(total_consumption_active_import) AS BIGINT) AS total_wh, "
    "count(DISTINCT lv_feeder_unique_id) AS n_feeders FROM published GROUP BY dno_alias",
)
def combine_dnos(spark, sf):
    parts = [T.to_published(nged_staging(spark, sf), "NGED"), T.to_published(ssen_staging(spark, sf), "SSEN")]
    both = SE.combine_dnos(parts)
    return both.groupBy("dno_alias").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("total_consumption_active_import").alias("total_wh"),
        F.count_distinct("lv_feeder_unique_id").alias("n_feeders"),
    )


@register(
    "utc_month_filter",
    "FI3",
    TD.duck_with("staging", "lookup_postcodes", "lookup_model")
    + "SELECT * FROM staging WHERE data_collection_log_timestamp >= TIMESTAMP '2024-01-01' AND data_collection_log_timestamp < TIMESTAMP '2024-02-01'",
)
def utc_month_filter(spark, sf):
    return FI.utc_month(staging(spark, sf), "2024-01")


@register(
    "out_of_month",
    "FI3 report, IN7",
    TD.duck_with("staging", "lookup_postcodes", "lookup_model")
    + "SELECT dno_alias, CAST(date_trunc('month', data_collection_log_timestamp) AS DATE) AS month, count(*) AS n_rows FROM staging "
    "WHERE NOT (data_collection_log_timestamp >= TIMESTAMP '2024-01-10' AND data_collection_log_timestamp < TIMESTAMP '2024-01-20') "
    "GROUP BY ALL",
)
def out_of_month(spark, sf):
    from ..operators.quality import outside_range_report

    return outside_range_report(staging(spark, sf), "2024-01-10", "2024-01-20", by=["dno_alias"])


# ---------------------------------------------------------------------------
# filters on the published table
# ---------------------------------------------------------------------------


@register(
    "settlement_period",
    "FI4",
    with_published() + f"SELECT {PUB_COLS} FROM published WHERE data_collection_log_timestamp = TIMESTAMP '2024-01-15 18:00:00'",
)
def settlement_period(spark, sf):
    return flat(FI.settlement_period(published(spark, sf), "2024-01-15 18:00:00"))


DNF = [
    [("dno_alias", "=", "SSEN"), ("total_consumption_active_import", ">", 20000)],
    [("dno_alias", "in", ["NGED"]), ("aggregated_device_count_active", "<=", 4), ("lv_feeder_unique_id", "!=", "NGED-000001-2")],
]


@register(
    "dnf_filter",
    "FI5",
    with_published()
    + f"SELECT {PUB_COLS} FROM published WHERE (dno_alias = 'SSEN' AND total_consumption_active_import > 20000) "
    "OR (dno_alias IN ('NGED') AND aggregated_device_count_active <= 4 AND lv_feeder_unique_id <> 'NGED-000001-2')",
)
def dnf_filter(spark, sf):
    return flat(FI.dnf_filter(published(spark, sf), DNF))


@register(
    "bbox",
    "FI6, GE10",
    with_published() + f"SELECT {PUB_COLS} FROM published WHERE longitude BETWEEN -2.5 AND -1.0 AND latitude BETWEEN 51.0 AND 57.5",
)
def bbox(spark, sf):
    return flat(FI.bbox_filter(published(spark, sf), -2.5, 51.0, -1.0, 57.5))


IN_LIST = ["SSEN-0000000002", "SSEN-0000000010", "NGED-000003", "NGED-000021", "NGED-000049"]


@register(
    "in_list",
    "FI7",
    with_published() + f"SELECT {PUB_COLS} FROM published WHERE secondary_substation_unique_id IN ("
    + ", ".join(repr(v) for v in IN_LIST)
    + ")",
)
def in_list(spark, sf):
    return flat(FI.in_list(published(spark, sf), "secondary_substation_unique_id", IN_LIST))


@register(
    "outliers",
    "FI8",
    with_published() + f"SELECT {PUB_COLS} FROM published WHERE total_consumption_active_import < 20000",
)
def outliers(spark, sf):
    return flat(FI.drop_outliers(published(spark, sf)))


@register(
    "null_rows",
    "FI11",
    TD.duck_with("nged_staging")
    + "SELECT DISTINCT secondary_substation_id FROM nged_staging WHERE dataset_id IS NULL OR dataset_id = ''",
)
def null_rows(spark, sf):
    return FI.null_rows(nged_staging(spark, sf), "dataset_id").select("secondary_substation_id").distinct()


# ---------------------------------------------------------------------------
# aggregates
# ---------------------------------------------------------------------------


def _stats_sql(table: str, dno: str, feeder: str, subs: str | None) -> str:
    sub = f"CAST(count(DISTINCT {subs}) + max(CAST({subs} IS NULL AS INT)) AS BIGINT)" if subs else "CAST(NULL AS BIGINT)"
    return (
        f"SELECT '{dno}' AS dno, CAST(date_trunc('month', data_collection_log_timestamp) AS DATE) AS month, count(*) AS row_count, "
        f"CAST(count(DISTINCT {feeder}) + max(CAST({feeder} IS NULL AS INT)) AS BIGINT) AS nunique_feeders, {sub} AS nunique_substations "
        f"FROM {table} GROUP BY 2"
    )


@register(
    "partition_stats",
    "AG1, N6",
    with_published()
    + _stats_sql("ssen_staging", "SSEN", "dataset_id", None)
    + " UNION ALL "
    + _stats_sql("nged_staging", "NGED", "secondary_substation_id || '-' || lv_feeder_id", None)
    + " UNION ALL "
    + _stats_sql("published", "COMBINED", "lv_feeder_unique_id", "secondary_substation_unique_id"),
)
def partition_stats(spark, sf):
    return A.feed_stats(staging(spark, sf))


@register(
    "substation_consumption",
    "AG5, FI8, PR19 (JB6)",
    with_published()
    + "SELECT data_collection_log_timestamp, secondary_substation_unique_id, longitude, latitude, "
    "CAST(sum(total_consumption_active_import) AS DOUBLE) / 1000.0 AS total_consumption_active_import, "
    "CAST(sum(aggregated_device_count_active) AS BIGINT) AS aggregated_device_count_active "
    "FROM published WHERE secondary_substation_unique_id IS NOT NULL "
    "GROUP BY data_collection_log_timestamp, secondary_substation_unique_id, longitude, latitude "
    "HAVING sum(total_consumption_active_import) < 20000",
)
def substation_consumption(spark, sf):
    from ..plans.analytics import consumption_map

    return flat(consumption_map(published(spark, sf), per_period=True))


@register(
    "feeder_summary",
    "AG6",
    with_published()
    + "SELECT lv_feeder_unique_id, count(*) AS n_rows, min(data_collection_log_timestamp) AS first_ts, max(data_collection_log_timestamp) AS last_ts, "
    "min(aggregated_device_count_active) AS min_devices, max(aggregated_device_count_active) AS max_devices, "
    "min(total_consumption_active_import) AS min_consumption, max(total_consumption_active_import) AS max_consumption "
    "FROM published GROUP BY lv_feeder_unique_id",
)
def feeder_summary(spark, sf):
    return A.feeder_summary(published(spark, sf))


_DEDUPE_ORDER_SQL = (
    "dataset_id NULLS LAST, total_consumption_active_import NULLS LAST, aggregated_device_count_active NULLS LAST, "
    "dno_alias NULLS LAST, longitude NULLS LAST, latitude NULLS LAST, secondary_substation_unique_id NULLS LAST"
)
DEDUPED_CTE = (
    ",\ndeduped AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY data_collection_log_timestamp, lv_feeder_unique_id "
    f"ORDER BY {_DEDUPE_ORDER_SQL}) AS rn FROM published) WHERE rn = 1)\n"
)


def deduped_published(spark, sf) -> DataFrame:
    return flat(W.dedupe_readings(published(spark, sf)))


@register("dedupe_readings", "WN1", with_published() + DEDUPED_CTE + f"SELECT {PUB_COLS} FROM deduped")
def dedupe_readings(spark, sf):
    return deduped_published(spark, sf)


@register(
    "daily_consumption",
    "WN1, FI8, PR19, PR20, AG7 (JB7)",
    with_published()
    + DEDUPED_CTE
    + """,
clean AS (SELECT lv_feeder_unique_id, CAST(data_collection_log_timestamp AS DATE) AS d,
  CAST((CAST(total_consumption_active_import AS DOUBLE) / 1000.0) / CAST(aggregated_device_count_active AS DOUBLE) AS DECIMAL(38,12)) AS v
  FROM deduped WHERE total_consumption_active_import < 20000),
bounds AS (SELECT min(d) AS lo, max(d) AS hi FROM clean),
feeders AS (SELECT DISTINCT lv_feeder_unique_id FROM clean),
spine AS (SELECT f.lv_feeder_unique_id, CAST(g.day AS DATE) AS d FROM feeders f, bounds b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) AS g(day)),
sums AS (SELECT lv_feeder_unique_id, d, sum(v) AS v FROM clean GROUP BY ALL)
SELECT s.lv_feeder_unique_id, CAST(s.d AS TIMESTAMP) AS day, coalesce(x.v, CAST(0 AS DECIMAL(38,12))) AS normalised_consumption
FROM spine s LEFT JOIN sums x ON s.lv_feeder_unique_id = x.lv_feeder_unique_id AND s.d = x.d""",
)
def daily_consumption(spark, sf):
    from ..plans.analytics import feeder_timeseries

    return feeder_timeseries(W.dedupe_readings(published(spark, sf)), dedupe=False, exact=True)


@register(
    "pivot_feeders",
    "WN1, AG8",
    TD.duck_with("staging", "lookup_postcodes", "lookup_model")
    + """, d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY data_collection_log_timestamp, dno_alias, secondary_substation_id, lv_feeder_id
  ORDER BY dataset_id NULLS LAST, total_consumption_active_import NULLS LAST, aggregated_device_count_active NULLS LAST,
  secondary_substation_name NULLS LAST, lv_feeder_name NULLS LAST, substation_geo_location NULLS LAST, insert_time NULLS LAST, last_modified_time NULLS LAST) AS rn FROM staging) WHERE rn = 1)
SELECT data_collection_log_timestamp, dno_alias, secondary_substation_id,
  max(CASE WHEN lv_feeder_id = '1' THEN total_consumption_active_import END) AS lv_feeder_id_1,
  max(CASE WHEN lv_feeder_id = '2' THEN total_consumption_active_import END) AS lv_feeder_id_2,
  max(CASE WHEN lv_feeder_id = '3' THEN total_consumption_active_import END) AS lv_feeder_id_3,
  max(CASE WHEN lv_feeder_id = '4' THEN total_consumption_active_import END) AS lv_feeder_id_4
FROM d GROUP BY ALL""",
)
def pivot_feeders(spark, sf):
    keys = [TS, "dno_alias", "secondary_substation_id", "lv_feeder_id"]
    d = W.dedupe_readings(staging(spark, sf), keys=keys)
    return A.pivot_feeders(d, keys[:3], "lv_feeder_id", ["1", "2", "3", "4"], "total_consumption_active_import")


@register(
    "readings_per_feeder",
    "AG9",
    with_published() + "SELECT lv_feeder_unique_id, count(DISTINCT data_collection_log_timestamp) AS n_timestamps FROM published GROUP BY 1",
)
def readings_per_feeder(spark, sf):
    return A.readings_per_feeder(published(spark, sf))


@register(
    "expected_readings",
    "AG10",
    with_published()
    + "SELECT CAST(date_diff('second', min(data_collection_log_timestamp), max(data_collection_log_timestamp)) AS DOUBLE) / 1800.0 AS expected_readings FROM published",
)
def expected_readings(spark, sf):
    return A.expected_readings(published(spark, sf))


@register(
    "gaps",
    "WN4",
    with_published()
    + """, p AS (SELECT DISTINCT lv_feeder_unique_id, data_collection_log_timestamp FROM published),
l AS (SELECT lv_feeder_unique_id, lag(data_collection_log_timestamp) OVER (PARTITION BY lv_feeder_unique_id ORDER BY data_collection_log_timestamp) AS prev,
  data_collection_log_timestamp AS ts FROM p)
SELECT lv_feeder_unique_id, prev AS gap_after, ts AS gap_before, CAST(date_diff('second', prev, ts) / 1800 - 1 AS BIGINT) AS missing_periods
FROM l WHERE date_diff('second', prev, ts) > 1800""",
)
def gaps(spark, sf):
    return W.gap_intervals(published(spark, sf))


_DAY1, _DAY2 = "2024-01-10", "2024-01-20"


@register(
    "day_comparison",
    "AG11",
    TD.duck_with("staging", "lookup_postcodes", "lookup_model")
    + f"SELECT CAST(data_collection_log_timestamp AS DATE) AS day, count(*) AS n_rows, count(DISTINCT data_collection_log_timestamp) AS n_timestamps, "
    "count(DISTINCT dataset_id) AS n_feeders, "
    + ", ".join(f"count({c}) AS nonnull_{c}" for c in S.CANONICAL_COLUMNS)
    + f" FROM staging WHERE CAST(data_collection_log_timestamp AS DATE) IN (DATE '{_DAY1}', DATE '{_DAY2}') GROUP BY 1",
)
def day_comparison(spark, sf):
    return A.day_comparison(staging(spark, sf), _DAY1, _DAY2)


@register(
    "vanished_feeders",
    "AG11",
    TD.duck_with("staging", "lookup_postcodes", "lookup_model")
    + f"SELECT DISTINCT dataset_id FROM staging WHERE CAST(data_collection_log_timestamp AS DATE) = DATE '{_DAY1}' "
    f"AND dataset_id NOT IN (SELECT dataset_id FROM staging WHERE CAST(data_collection_log_timestamp AS DATE) = DATE '{_DAY2}' AND dataset_id IS NOT NULL) "
    "AND dataset_id IS NOT NULL",
)
def vanished_feeders(spark, sf):
    df = staging(spark, sf).where(F.col("dataset_id").isNotNull())
    return A.vanished_feeders(df, _DAY1, _DAY2)


@register(
    "null_audit",
    "AG12",
    TD.duck_with("nged_staging")
    + "SELECT CAST(data_collection_log_timestamp AS DATE) AS day, count(*) AS n_rows, "
    + ", ".join(f"count({c}) AS nonnull_{c}" for c in S.CANONICAL_COLUMNS if c != TS)
    + " FROM nged_staging GROUP BY 1",
)
def null_audit(spark, sf):
    df = nged_staging(spark, sf).withColumn("day", F.to_date(TS)).drop(TS)
    return A.null_audit(df, by=["day"])


@register(
    "new_missing_by_day",
    "WN3, SE4",
    TD.duck_with("nged_staging")
    + """, m AS (SELECT DISTINCT secondary_substation_id, CAST(data_collection_log_timestamp AS DATE) AS day FROM nged_staging WHERE dataset_id IS NULL)
SELECT secondary_substation_id, day FROM (SELECT *, min(day) OVER (PARTITION BY secondary_substation_id) AS f FROM m) WHERE day = f""",
)
def new_missing_by_day(spark, sf):
    m = nged_staging(spark, sf).where(F.col("dataset_id").isNull()).withColumn("day", F.to_date(TS))
    return W.new_missing_by_month(m, month="day")


@register(
    "backfill_candidates",
    "JN7",
    TD.duck_with("nged_staging")
    + """, missing AS (SELECT DISTINCT secondary_substation_id FROM nged_staging WHERE dataset_id IS NULL),
c AS (SELECT s.*, row_number() OVER (PARTITION BY s.secondary_substation_id ORDER BY data_collection_log_timestamp NULLS LAST, lv_feeder_id NULLS LAST,
  dataset_id NULLS LAST, total_consumption_active_import NULLS LAST, aggregated_device_count_active NULLS LAST, insert_time NULLS LAST) AS rn
  FROM nged_staging s WHERE s.dataset_id IS NOT NULL AND s.dataset_id <> '' AND s.secondary_substation_id IN (SELECT secondary_substation_id FROM missing))
SELECT * EXCLUDE (rn) FROM c WHERE rn = 1""",
)
def backfill_candidates(spark, sf):
    df = nged_staging(spark, sf)
    missing = df.where(F.col("dataset_id").isNull()).select("secondary_substation_id")
    order = [TS, "lv_feeder_id", "dataset_id", "total_consumption_active_import", "aggregated_device_count_active", "insert_time"]
    return J.backfill_candidates(df, missing, order=order)


@register(
    "top_feeders",
    "AG9, SO5",
    with_published()
    + "SELECT lv_feeder_unique_id, CAST(sum(total_consumption_active_import) AS BIGINT) AS total_wh FROM published "
    "GROUP BY 1 ORDER BY total_wh DESC, lv_feeder_unique_id LIMIT 10",
)
def top_feeders(spark, sf):
    sums = published(spark, sf).groupBy("lv_feeder_unique_id").agg(F.sum("total_consumption_active_import").alias("total_wh"))
    return O.top_n(sums, "total_wh", 10, ["lv_feeder_unique_id"])


@register(
    "sample_feeders",
    "SO4, JB8 (seeded by md5)",
    with_published()
    + ", picked AS (SELECT DISTINCT lv_feeder_unique_id AS id FROM published WHERE lv_feeder_unique_id IS NOT NULL ORDER BY md5(lv_feeder_unique_id || '#42'), 1 LIMIT 5) "
    "SELECT data_collection_log_timestamp, secondary_substation_unique_id, lv_feeder_unique_id, latitude, longitude, aggregated_device_count_active, "
    "total_consumption_active_import FROM published WHERE lv_feeder_unique_id IN (SELECT id FROM picked)",
)
def sample_feeders(spark, sf):
    from ..plans.analytics import feeder_extract

    return feeder_extract(published(spark, sf), n=5, seed=42)


@register(
    "insert_lag",
    "IN7 (exact percentiles from counts)",
    TD.duck_with("staging", "lookup_postcodes", "lookup_model")
    + """, l AS (SELECT dno_alias, CAST(date_diff('second', data_collection_log_timestamp, insert_time) AS DOUBLE) AS lag FROM staging)
SELECT dno_alias, quantile_cont(lag, 0.5) AS lag_p50_s, quantile_cont(lag, 0.9) AS lag_p90_s, max(lag) AS lag_max_s FROM l GROUP BY 1""",
)
def insert_lag(spark, sf):
    from ..operators.quality import insert_lag_profile

    return insert_lag_profile(staging(spark, sf), by=["dno_alias"], exact=True)


_BAD = (
    "(aggregated_device_count_active IS NOT NULL AND TRY_CAST(aggregated_device_count_active AS DOUBLE) IS NULL) "
    "OR (total_consumption_active_import IS NOT NULL AND TRY_CAST(total_consumption_active_import AS DOUBLE) IS NULL) "
    + " ".join(f"OR ({c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL)" for c in S.TIME_COLUMNS)
)


@register(
    "quarantine_bad_files",
    "SK6, JB4",
    TD.duck_with("raw_readings_dirty") + f"SELECT source_file, count(*) AS bad_rows FROM raw_readings_dirty WHERE {_BAD} GROUP BY 1",
)
def quarantine_bad_files(spark, sf):
    from ..operators.quality import quarantine_bad_files as qbf

    return qbf(TD.view(spark, sf, "raw_readings_dirty"))[1]


@register(
    "quarantine_good_rows",
    "SK6, JB4, AG1",
    TD.duck_with("raw_readings_dirty")
    + f"SELECT source_file, count(*) AS row_count, count(DISTINCT dataset_id) AS nunique_feeders FROM raw_readings_dirty "
    f"WHERE source_file NOT IN (SELECT source_file FROM raw_readings_dirty WHERE {_BAD}) GROUP BY 1",
)
def quarantine_good_rows(spark, sf):
    from ..operators.quality import quarantine_bad_files as qbf

    good = qbf(TD.view(spark, sf, "raw_readings_dirty"))[0]
    return good.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("dataset_id").alias("nunique_feeders"))


@register(
    "month_domain",
    "PR22",
    TD.duck_with("readings")
    + "SELECT CAST(g.m AS DATE) AS month FROM (SELECT date_trunc('month', min(data_collection_log_timestamp)) AS lo, "
    "date_trunc('month', max(data_collection_log_timestamp)) AS hi FROM readings) b, generate_series(b.lo, b.hi, INTERVAL 1 MONTH) AS g(m)",
)
def month_domain(spark, sf):
    from ..functions.timefns import month_start

    rd = TD.readings(spark, sf)
    lo = rd.select(F.min(month_start(TS))).scalar()
    hi = rd.select(F.max(month_start(TS))).scalar()
    return spark.range(1).select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("month"))


@register(
    "new_missing_by_month",
    "WN3, SE4",
    TD.duck_with("nged_staging")
    + """, m AS (SELECT DISTINCT secondary_substation_id, CAST(date_trunc('month', data_collection_log_timestamp) AS DATE) AS month FROM nged_staging WHERE dataset_id IS NULL)
SELECT secondary_substation_id, month FROM (SELECT *, min(month) OVER (PARTITION BY secondary_substation_id) AS f FROM m) WHERE month = f""",
)
def new_missing_by_month(spark, sf):
    from ..functions.timefns import month_start

    m = nged_staging(spark, sf).where(F.col("dataset_id").isNull()).withColumn("month", month_start(TS))
    return W.new_missing_by_month(m, month="month")
