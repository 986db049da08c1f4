"""Queries through real files: the tables' rows land as the CSV files sources
publish, and readers, jobs, sinks and streams run on those. Three months of
readings come from ``lineitem`` (a third of them one feeder's), half of the files
with their columns in another order."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import filters as FI
from ..operators import joins as J
from ..operators import ordering as O
from ..operators import quality as Q
from ..operators import setops as SE
from ..operators import transform as T
from ..operators import windows as W
from ..plans import analytics as AN
from ..plans import jobs as JB
from ..plans import month_stats as MS
from ..session import checkpoint_dir
from ..sinks import files as SINK
from ..sources import manifests as M
from ..sources import readers as R
from ..sources import testdata as TD
from ..streaming import ingest as ST
from .registry import register

TS = "data_collection_log_timestamp"
MONTHS = ["2024-01-01", "2024-02-01", "2024-03-01"]
SSEN, NGED = "source_file LIKE '20%'", "source_file LIKE 'aggregated%'"

_LANDED: dict[tuple, str] = {}


def folder(spark: SparkSession, name: str) -> str:
    try:
        app = spark.sparkContext.applicationId
    except Exception:
        app = "session"
    return f"{checkpoint_dir(spark).rstrip('/')}/meterflow-scratch-{app}/{name}-{uuid.uuid4().hex}"


def landed(spark: SparkSession, sf: str, view: str, rows: str, **how) -> str:
    """The folder with the files of a view's ``rows``, landed once per application."""
    key = (spark.sparkContext.applicationId, sf, view, rows)
    if key not in _LANDED:
        path = folder(spark, view)
        TD.land_csv(TD.view(spark, sf, view).where(rows), path, **how)
        _LANDED[key] = path
    return _LANDED[key]


def one_file(spark: SparkSession, sf: str, view: str, name: str, order: str) -> str:
    """A whole view in one CSV file, in the order of a column."""
    key = (spark.sparkContext.applicationId, sf, view, name)
    if key not in _LANDED:
        path = folder(spark, view)
        TD.land_csv(TD.view(spark, sf, view).withColumn("file", F.lit(name)), path, "file", order=order)
        _LANDED[key] = path
    return f"{_LANDED[key]}/{name}"


def naive(df: DataFrame) -> DataFrame:
    """Timestamps as they stand in the files, whatever the session's time zone."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if f.dataType.typeName() == "timestamp"})


def lookup(spark: SparkSession, sf: str) -> DataFrame:
    return J.merged_location_lookup(TD.view(spark, sf, "lookup_postcodes"), TD.view(spark, sf, "lookup_model"))


# ---------------------------------------------------------------- oracle text

_COLS = ", ".join(S.CANONICAL_COLUMNS)
_TOKENS = ", ".join("'" + t + "'" for t in S.NGED_BLANK_TOKENS)


def _clean(c: str) -> str:
    blank = f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END"
    return (f"coalesce({blank}, 'NGED')" if c == "dno_alias" else blank) + f" AS {c}" if c in S.NGED_BLANK_COLUMNS else c


_MONTH = f"CAST(date_trunc('month', {TS}) AS DATE)"
_FILE_MONTH = "CASE WHEN source_file LIKE '20%' THEN CAST(substr(source_file, 1, 7) || '-01' AS DATE) ELSE CAST(substr(source_file, 39, 7) || '-01' AS DATE) END"
_IN_MONTHS = f"IN ({', '.join(f'DATE {m!r}' for m in MONTHS)})"


def with_months(*extra: str) -> str:
    """months, then staged: what the month jobs write; made: what they publish."""
    ssen = ", ".join("l.substation_geo_location AS substation_geo_location" if c == "substation_geo_location" else f"m.{c} AS {c}" for c in S.CANONICAL_COLUMNS)
    return (
        TD.duck_with("months", "merged_lookup").rstrip("\n")
        + f""",
filed AS (SELECT *, {_FILE_MONTH} AS month FROM months),
ssen_all AS (SELECT {ssen}, month FROM filed m LEFT JOIN merged_lookup l ON substr(m.dataset_id, 1, 10) = l.substation_nrn WHERE {SSEN}),
nged_all AS (SELECT {", ".join(_clean(c) for c in S.CANONICAL_COLUMNS)}, month FROM filed WHERE {NGED}),
staged AS (SELECT 'SSEN' AS dno, * FROM ssen_all WHERE month {_IN_MONTHS} UNION ALL SELECT 'NGED', * FROM nged_all WHERE month {_IN_MONTHS} AND month = {_MONTH}),
made AS (SELECT dataset_id, dno_alias, month,
  CAST(round_even(aggregated_device_count_active, 0) AS BIGINT) AS aggregated_device_count_active,
  CAST(round_even(total_consumption_active_import, 0) AS BIGINT) AS total_consumption_active_import, {TS},
  CASE WHEN substation_geo_location IS NULL THEN NULL ELSE CAST(trim(substr(substation_geo_location, strpos(substation_geo_location, ',') + 1)) AS DOUBLE) END AS longitude,
  CASE WHEN substation_geo_location IS NULL THEN NULL ELSE CAST(trim(split_part(substation_geo_location, ',', 1)) AS DOUBLE) END AS latitude,
  CASE WHEN dno = 'NGED' THEN 'NGED-' || secondary_substation_id ELSE 'SSEN-' || substr(dataset_id, 1, 10) END AS secondary_substation_unique_id,
  CASE WHEN dno = 'NGED' THEN 'NGED-' || secondary_substation_id || '-' || lv_feeder_id ELSE 'SSEN-' || dataset_id END AS lv_feeder_unique_id
  FROM staged WHERE month = {_MONTH})"""
        + "".join(extra)
        + "\n"
    )


# ---------------------------------------------------------------- readers


@register("csv_daily_roundtrip", "SC1, PR1, N1", TD.duck_with("months") + f"SELECT {_COLS} FROM months WHERE {SSEN}")
def csv_daily_roundtrip(spark, sf):
    return naive(R.read_daily_readings(spark, landed(spark, sf, "raw_months", SSEN)))


@register("csv_part_roundtrip", "SC2, PR2, PR1", TD.duck_with("months") + f"SELECT {_COLS} FROM months WHERE {NGED}")
def csv_part_roundtrip(spark, sf):
    return naive(R.read_part_readings(spark, nged_files(spark, sf)))


def nged_files(spark: SparkSession, sf: str) -> str:
    """Part files with the header spellings of their source."""
    key = (spark.sparkContext.applicationId, sf, "nged")
    if key not in _LANDED:
        path = folder(spark, "nged")
        TD.land_csv(TD.view(spark, sf, "raw_months").where(NGED).withColumnsRenamed({v: k for k, v in S.NGED_RENAMES.items()}), path)
        _LANDED[key] = path
    return _LANDED[key]


@register("mapping_roundtrip", "SC3", TD.duck_with("mapping") + "SELECT * FROM mapping")
def mapping_roundtrip(spark, sf):
    raw = TD.view(spark, sf, "mapping").withColumn("nr", F.xxhash64("dataset_id", "postcode"))
    key = (spark.sparkContext.applicationId, sf, "mapping")
    if key not in _LANDED:
        _LANDED[key] = folder(spark, "mapping")
        TD.land_csv(raw.withColumn("file", F.concat(F.lit("mapping-"), F.pmod("nr", F.lit(3)), F.lit(".csv.gz"))).drop("nr"), _LANDED[key], "file")
    return R.read_postcode_mapping(spark, _LANDED[key])


@register(
    "directory_roundtrip",
    "SC4, N8",
    TD.duck_with("directory")
    + "SELECT pcd, CASE WHEN lat = '99.999999' THEN NULL ELSE CAST(lat AS DOUBLE) END AS lat, CASE WHEN \"long\" = '0.000000' THEN NULL ELSE CAST(\"long\" AS DOUBLE) END AS \"long\" FROM directory",
)
def directory_roundtrip(spark, sf):
    path = one_file(spark, sf, "directory", "ONSPD_TEST.csv", "nation")
    return R.read_postcode_directory(spark, path.rsplit("/", 1)[0], ["pcd", "lat", "long"])


@register(
    "dedupe_model_strict",
    "SC5, WN2 (strict: the first row of the file)",
    TD.duck_with("model")
    + "SELECT full_nrn, latitude, longitude FROM (SELECT full_nrn, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, "
    "row_number() OVER (PARTITION BY full_nrn ORDER BY file_row) AS rn FROM model) WHERE rn = 1",
)
def dedupe_model_strict(spark, sf):
    model = R.read_transformer_model(spark, one_file(spark, sf, "model", "transformers.csv", "file_row"), ["full_nrn", "latitude", "longitude"])
    return W.dedupe_model(model, strict=True).drop("file_row")


@register(
    "lookup_roundtrip",
    "SK3, SC8, JN1",
    TD.duck_with("merged_lookup") + "SELECT substation_nrn, substation_geo_location FROM merged_lookup",
)
def lookup_roundtrip(spark, sf):
    path = folder(spark, "lookup")
    SINK.write_location_lookup(lookup(spark, sf), path)
    return R.read_location_lookup(spark, path)


@register("npg_listing", "SC11", "SELECT DISTINCT 'https://files.example/lv-feeder-' || CAST(o_custkey AS VARCHAR) || '.csv' AS url FROM orders WHERE o_custkey % 2 = 0")
def npg_listing(spark, sf):
    made = TD.table(spark, sf, "orders").select("o_custkey").distinct()
    kind = F.when(F.col("o_custkey") % 2 == 0, F.lit("lv-feeder-data")).otherwise(F.lit("report"))
    entry = F.struct(F.concat(F.lit("https://files.example/lv-feeder-"), "o_custkey", F.lit(".csv")).alias("href"), F.struct(kind.alias("id"), F.lit("t").alias("title")).alias("metas"))
    path = folder(spark, "npg")
    # a document per file, as a portal gives them
    pages = made.groupBy(F.pmod("o_custkey", F.lit(16)).alias("page")).agg(F.collect_list(entry).alias("attachments"))
    pages.write.partitionBy("page").json(path)
    return M.file_manifest_npg(spark, path).select("url")


# ---------------------------------------------------------------- month jobs


def staged(spark: SparkSession, sf: str) -> dict:
    """The three months built from their files (JB1, JB2)."""
    key = (spark.sparkContext.applicationId, sf, "staged")
    if key not in _LANDED:
        root = folder(spark, "staging")
        ssen = JB.build_ssen_months(spark, landed(spark, sf, "raw_months", SSEN), lookup(spark, sf), root, MONTHS)
        nged = JB.build_nged_months(spark, nged_files(spark, sf), root, MONTHS)
        _LANDED[key] = {"root": root, "SSEN": ssen, "NGED": nged}
    return _LANDED[key]


def published(spark: SparkSession, sf: str) -> dict:
    """... and published (JB3)."""
    key = (spark.sparkContext.applicationId, sf, "published")
    if key not in _LANDED:
        root = folder(spark, "published")
        _LANDED[key] = {"root": root, "COMBINED": JB.build_combined_months(spark, staged(spark, sf)["root"], root, MONTHS)}
    return _LANDED[key]


@register("staged_months", "JB1, JB2, SK1, SK5, PR3, PR4, FI3 (rows are cut)", with_months() + f"SELECT dno, {_COLS}, month FROM staged")
def staged_months(spark, sf):
    return naive(R.read_staging(spark, staged(spark, sf)["root"])).select("dno", *S.CANONICAL_COLUMNS, "month")


@register(
    "staging_month",
    "SC6, FI3",
    with_months() + f"SELECT {_COLS} FROM staged WHERE dno = 'SSEN' AND month = DATE '2024-02-01' AND {TS} >= TIMESTAMP '2024-02-01' AND {TS} < TIMESTAMP '2024-03-01'",
)
def staging_month(spark, sf):
    return naive(R.read_staging_month(spark, staged(spark, sf)["root"], "SSEN", "2024-02"))


@register(
    "month_job_stats",
    "AG1, JB1, JB2, JB3 (statistics of the builds)",
    with_months()
    + f"SELECT 'SSEN' AS dno, month, count(*) AS row_count, count(DISTINCT dataset_id) AS nunique_feeders FROM ssen_all WHERE month {_IN_MONTHS} GROUP BY month "
    f"UNION ALL SELECT 'NGED', month, count(*), count(DISTINCT secondary_substation_id || '-' || lv_feeder_id) FROM nged_all WHERE month {_IN_MONTHS} GROUP BY month "
    "UNION ALL SELECT 'COMBINED', month, count(*), count(DISTINCT lv_feeder_unique_id) FROM made GROUP BY month",
)
def month_job_stats(spark, sf):
    built = {**staged(spark, sf), **published(spark, sf)}
    return SE.concat([built[d].stats.select(F.lit(d).alias("dno"), "month", "row_count", F.col("nunique_feeders").cast("long")) for d in ("SSEN", "NGED", "COMBINED")])


@register(
    "rows_outside_month",
    "FI3 report, JB2",
    with_months() + f"SELECT month, count(*) AS rows_outside_month FROM nged_all WHERE month {_IN_MONTHS} AND month <> {_MONTH} GROUP BY month",
)
def rows_outside_month(spark, sf):
    return staged(spark, sf)["NGED"].outside


@register("late_rows", "IN7", with_months() + f"SELECT source_file, {TS} FROM filed WHERE {_MONTH} <> month")
def late_rows(spark, sf):
    rows = R.read_daily_readings(spark, landed(spark, sf, "raw_months", SSEN), with_file=True)
    rows = rows.unionByName(R.read_part_readings(spark, nged_files(spark, sf), with_file=True))
    name = C.filename_from_url("source_file")
    month = F.coalesce(C.month_from_ssen_url(name), C.month_from_nged_url(name))
    late = Q.late_rows(rows.withColumns({"source_file": name, "file_month": month}))
    return naive(late.select("source_file", TS))


_PUB = "dataset_id, dno_alias, aggregated_device_count_active, total_consumption_active_import, " + TS + ", longitude, latitude, secondary_substation_unique_id, lv_feeder_unique_id"


def naive_empty(df: DataFrame) -> DataFrame:
    """Published rows with longitude and latitude; an empty point has neither."""
    flat = naive(T.flatten_geometry(df))
    return flat.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("longitude", "latitude")})


@register("published_roundtrip", "JB3, SK2, SC7, SO2", with_months() + f"SELECT {_PUB}, month FROM made")
def published_roundtrip(spark, sf):
    return naive_empty(R.read_readings(spark, published(spark, sf)["root"]))


@register(
    "published_box",
    "SC7, FI5, FI6, GE10, PR17 (files, months and columns pruned)",
    with_months()
    + f"SELECT lv_feeder_unique_id, {TS}, total_consumption_active_import FROM made WHERE {TS} >= TIMESTAMP '2024-02-01' AND {TS} < TIMESTAMP '2024-02-20' "
    "AND longitude BETWEEN -2.5 AND -2.1 AND latitude BETWEEN 51.0 AND 55.0",
)
def published_box(spark, sf):
    out = R.read_readings(
        spark, published(spark, sf)["root"], columns=["lv_feeder_unique_id", TS, "total_consumption_active_import"],
        filters=[(TS, ">=", "2024-02-01 00:00:00"), (TS, "<", "2024-02-20 00:00:00")], bbox=(-2.5, 51.0, -2.1, 55.0),
    )
    return naive(out)


@register(
    "substation_totals",
    "AG5, FI8, PR19 (JB6, all half hours together)",
    with_months(
        f""",
half_hours AS (SELECT {TS}, secondary_substation_unique_id, longitude, latitude, sum(total_consumption_active_import) AS wh, sum(aggregated_device_count_active) AS devices
  FROM made GROUP BY ALL HAVING sum(total_consumption_active_import) < 20000)"""
    )
    + "SELECT secondary_substation_unique_id, longitude, latitude, CAST(sum(wh) AS DOUBLE) / 1000.0 AS total_consumption_active_import, "
    "CAST(sum(devices) AS BIGINT) AS aggregated_device_count_active FROM half_hours GROUP BY ALL",
)
def substation_totals(spark, sf):
    """The outlier cut stays on a half hour's sum, as the maps do (FI8)."""
    return naive_empty(AN.consumption_map(R.read_readings(spark, published(spark, sf)["root"])))


@register(
    "csv_extract_roundtrip",
    "SK4, SO3, PR17",
    with_months()
    + f"SELECT strftime({TS}, '%Y-%m-%d %H:%M:%S') AS ts, lv_feeder_unique_id, CAST(total_consumption_active_import AS VARCHAR) AS wh, "
    f"row_number() OVER (ORDER BY {TS}, lv_feeder_unique_id, total_consumption_active_import NULLS LAST) - 1 AS nr FROM made WHERE {TS} >= TIMESTAMP '2024-03-30'",
)
def csv_extract_roundtrip(spark, sf):
    """A sorted extract, written and read again in the order of its files."""
    from ..sources.csvfiles import read_csv

    rows = naive(R.read_readings(spark, published(spark, sf)["root"], filters=[(TS, ">=", "2024-03-30 00:00:00")]))
    ordered = O.extract_order(rows, [TS, "lv_feeder_unique_id", "total_consumption_active_import"])
    path = folder(spark, "extract")
    out = ordered.select(F.date_format(TS, "yyyy-MM-dd HH:mm:ss").alias("ts"), "lv_feeder_unique_id", F.col("total_consumption_active_import").alias("wh"))
    SINK.write_csv_extract(out, path, ["ts", "lv_feeder_unique_id", "wh"])
    back = read_csv(spark, path, position=True)
    counted = O.numbered(back, ["file_row"], "nr")
    return counted.select("ts", "lv_feeder_unique_id", "wh", "nr")


# ---------------------------------------------------------------- ingest and statistics

_DIRTY = f"SELECT source_file, count(*) AS row_count, count(DISTINCT dataset_id) AS nunique_feeders FROM raw_months_dirty WHERE {SSEN} AND source_file NOT IN (SELECT source_file FROM raw_months_dirty WHERE total_consumption_active_import = 'n/a') GROUP BY 1"


@register("ingest_raw_files", "JB4, SK6, AG1 (files parsed once)", TD.duck_with("raw_months_dirty") + _DIRTY)
def ingest_raw_files(spark, sf):
    out = JB.ingest_raw(spark, landed(spark, sf, "raw_months_dirty", SSEN), "SSEN")
    return out["stats"].select(C.filename_from_url("source_file").alias("source_file"), "row_count", "nunique_feeders")


@register(
    "ingest_profile",
    "AG15, JB4",
    "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{c}', '{'double' if c in S.FLOAT_COLUMNS else 'timestamp' if c in S.TIME_COLUMNS else 'string'}')" for i, c in enumerate(S.CANONICAL_COLUMNS))
    + ") t(position, name, type)",
)
def ingest_profile(spark, sf):
    return JB.ingest_raw(spark, landed(spark, sf, "raw_months_dirty", SSEN), "SSEN")["schema"].select("position", "name", "type")


@register(
    "reference_profiles",
    "JB5, AG2, SC3, SC5",
    TD.duck_with("mapping", "model")
    + "SELECT 'mapping' AS input, count(*) AS row_count, count(DISTINCT postcode) AS n_distinct, CAST(NULL AS BIGINT) AS n_missing FROM mapping "
    "UNION ALL SELECT 'model', count(*), count(DISTINCT full_nrn), count(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) FROM model",
)
def reference_profiles(spark, sf):
    model = R.read_transformer_model(spark, one_file(spark, sf, "model", "transformers.csv", "file_row"), ["full_nrn", "latitude", "longitude"])
    out = JB.ingest_reference_data(mapping_roundtrip(spark, sf), model)
    a = out["mapping"].select(F.lit("mapping").alias("input"), "row_count", F.col("nunique_postcodes").alias("n_distinct"), F.lit(None).cast("long").alias("n_missing"))
    b = out["model"].select(F.lit("model").alias("input"), "row_count", F.col("nunique_substations").alias("n_distinct"), F.col("number_of_na_locations").alias("n_missing"))
    return a.unionByName(b)


@register(
    "incremental_month_stats",
    "AG1 (across batches, a day landing anew)",
    TD.duck_with("months")
    + f"SELECT CAST(substr(source_file, 1, 7) || '-01' AS DATE) AS month, count(*) AS row_count, count(DISTINCT dataset_id) AS nunique_feeders, "
    f"count(DISTINCT secondary_substation_id) AS nunique_substations FROM months WHERE {SSEN} GROUP BY 1",
)
def incremental_month_stats(spark, sf):
    """Month by month; one day first lands with a part of its rows, then whole."""
    rows = TD.view(spark, sf, "raw_months").where(SSEN)
    rows = rows.withColumn("month", C.month_from_ssen_url("source_file"))
    keys = {"feeders": F.col("dataset_id"), "substations": F.col("secondary_substation_id")}
    root, again = folder(spark, "month-stats"), "2024-02-11.csv.gz"
    early = rows.where("month < DATE '2024-03-01'")
    MS.update_stats(spark, root, early.where((F.col("source_file") != again) | (F.col("lv_feeder_id") == "1")), keys)
    MS.update_stats(spark, root, rows.where("month >= DATE '2024-03-01'"), keys)
    MS.update_stats(spark, root, rows.where(F.col("source_file") == again), keys, [again])
    return MS.month_stats(spark, root, list(keys))


# ---------------------------------------------------------------- streams


@register(
    "ingest_stream_months",
    "IN6, JB1 (new files of a stream, their months built)",
    with_months() + "SELECT month, count(*) AS n_rows, sum(total_consumption_active_import) AS wh FROM staged WHERE dno = 'SSEN' GROUP BY month",
)
def ingest_stream_months(spark, sf):
    raw, root = landed(spark, sf, "raw_months", SSEN), folder(spark, "stream-staging")
    wanted = lookup(spark, sf)

    def rebuild(months: list[str]) -> None:
        JB.build_ssen_months(spark, raw, wanted, root, [m for m in months if m in MONTHS])

    ST.ingest_stream(spark, raw, rebuild, glob="20*.csv.gz")
    return R.read_staging(spark, root).groupBy("month").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_consumption_active_import").alias("wh"))


_KEYS = [TS, "dno_alias", "secondary_substation_id", "lv_feeder_id"]


@register(
    "two_streams_one_output",
    "IN8 (two checkpoints, rows in both, files of other days)",
    TD.duck_with("months") + "SELECT DISTINCT " + ", ".join(_KEYS) + " FROM months",
)
def two_streams_one_output(spark, sf):
    schema = TD.table(spark, sf, "lineitem").schema
    out = folder(spark, "two-streams")
    for nr, rows in enumerate(("l_linenumber <= 4", "l_linenumber >= 4")):
        stream = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf.rstrip("/")).where(rows)
        raw = stream.selectExpr(*[f"{e} AS {c}" for c, e in TD.VIEWS["raw_months"][1]])
        typed = R.canonical_columns(raw, timestamp_type="timestamp_ntz")
        ST.dedupe_stream(typed.select(*_KEYS), _KEYS, out, f"{out}-checkpoint-{nr}")
    return spark.read.schema(typed.select(*_KEYS).schema).parquet(out).select(*_KEYS)


# ---------------------------------------------------------------- samples, domains, pivots


_EXTRACT = f"{TS}, secondary_substation_unique_id, lv_feeder_unique_id, latitude, longitude, aggregated_device_count_active, total_consumption_active_import"


def _sample_sql(n: int, seed: int, by: str | None) -> str:
    part = f"PARTITION BY {by} " if by else ""
    key = f"{by}, " if by else ""
    return (
        f", ids AS (SELECT DISTINCT {key}lv_feeder_unique_id FROM made WHERE lv_feeder_unique_id IS NOT NULL), "
        f"picked AS (SELECT lv_feeder_unique_id FROM (SELECT *, row_number() OVER ({part}ORDER BY md5(lv_feeder_unique_id || '#{seed}'), lv_feeder_unique_id) AS rn FROM ids) WHERE rn <= {n}) "
        f"SELECT {_EXTRACT} FROM made WHERE lv_feeder_unique_id IN (SELECT lv_feeder_unique_id FROM picked)"
    )


@register("sample_feeders_by_network", "SO4 (per region), JB8, FI7", with_months() + _sample_sql(3, 11, "dno_alias"))
def sample_feeders_by_network(spark, sf):
    rows = R.read_published(spark, published(spark, sf)["root"])
    out = naive(AN.feeder_extract(rows, n=3, seed=11, by="dno_alias"))
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("longitude", "latitude")})


@register(
    "source_months",
    "PR22 (months of each source on the last day of the data)",
    TD.duck_with("months")
    + f", today AS (SELECT CAST(max({TS}) AS DATE) AS d FROM months) "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS source, CAST(g.m AS DATE) AS month FROM today, generate_series(DATE '{first}', date_trunc('month', {end}), INTERVAL 1 MONTH) AS g(m)"
        for s, first, end in (("SSEN", S.SSEN_FIRST_MONTH, "d"), ("NGED", S.NGED_FIRST_MONTH, "d - INTERVAL 1 MONTH"), ("COMBINED", S.COMBINED_FIRST_MONTH, "d"))
    ),
)
def source_months(spark, sf):
    rows = R.canonical_columns(TD.view(spark, sf, "raw_months"), timestamp_type="timestamp_ntz")
    today = rows.select(F.max(TS)).scalar()
    return SE.concat([T.source_months(spark, s, today).select(F.lit(s).alias("source"), "month") for s in ("SSEN", "NGED", "COMBINED")])


@register(
    "pivot_all_feeders",
    "AG8 (all feeders present, in blocks of columns)",
    with_months()
    + f", d AS (SELECT {TS}, lv_feeder_unique_id, min(total_consumption_active_import) AS wh FROM made GROUP BY ALL) SELECT {TS}, lv_feeder_unique_id, wh FROM d WHERE wh IS NOT NULL",
)
def pivot_all_feeders(spark, sf):
    rows = naive(R.read_published(spark, published(spark, sf)["root"]))
    cells = rows.groupBy(TS, "lv_feeder_unique_id").agg(F.min("total_consumption_active_import").alias("wh"))
    blocks, columns = A.pivot_blocks(cells, [TS], "lv_feeder_unique_id", "wh", width=64)
    return A.unpivot_blocks(blocks, columns, [TS], "lv_feeder_unique_id", "wh")


@register(
    "union_ids",
    "SE4",
    TD.duck_with("months") + "SELECT dataset_id AS id FROM months UNION SELECT lpad(CAST(c_custkey * 3 AS VARCHAR), 10, '0') FROM customer",
)
def union_ids(spark, sf):
    rows = R.canonical_columns(TD.view(spark, sf, "raw_months"), timestamp_type="timestamp_ntz")
    return SE.union_ids(rows.select(F.col("dataset_id").alias("id")), TD.view(spark, sf, "lookup_postcodes").select(F.col("substation_nrn").alias("id")))


@register(
    "missing_first_months",
    "WN3 (over several months)",
    with_months()
    + ", m AS (SELECT DISTINCT secondary_substation_id, month FROM staged WHERE dno = 'NGED' AND dataset_id IS NULL) "
    "SELECT secondary_substation_id, month FROM (SELECT *, min(month) OVER (PARTITION BY secondary_substation_id) AS f FROM m) WHERE month = f",
)
def missing_first_months(spark, sf):
    rows = R.read_staging(spark, staged(spark, sf)["root"]).where("dno = 'NGED' AND dataset_id IS NULL")
    return W.new_missing_by_month(rows)


@register(
    "month_boundary_rows",
    "FI3 (rows are cut)",
    TD.duck_with("months") + f"SELECT {_COLS} FROM months WHERE {TS} >= TIMESTAMP '2024-02-01' AND {TS} < TIMESTAMP '2024-03-01'",
)
def month_boundary_rows(spark, sf):
    return FI.utc_month(R.canonical_columns(TD.view(spark, sf, "raw_months"), timestamp_type="timestamp_ntz"), "2024-02")
