"""Meter-shaped views over the driver's generic test tables.

The test tables hold no smart-meter data, so each view derives one from a
given table with integer arithmetic and text functions only. Every column is
one SQL expression that runs unchanged on Spark and on DuckDB; the oracle
queries use the same text as CTEs, so both engines see identical inputs.

  raw_readings  <- events     17 text columns, as a CSV read gives them
  readings      <- raw        12 typed staging columns (timestamps naive UTC)
  lookup_postcodes <- customer, lookup_model <- part   (location lookups A, B)
  mapping       <- customer   feeder -> postcode mapping (text)
  directory     <- supplier   postcode directory (text lat/long, sentinels)
  model         <- part       transformer load model (text, duplicates)
  points        <- embeddings 2-d points grouped by label
  ssen_listing / nged_listing / materialisations <- orders
"""

from __future__ import annotations

import csv
import gzip
import io
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import blank_to_null
from .readers import canonical_columns, rename_nged

try:  # Python workers get this module's functions by value
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover
    pass


def _postcode(k: str) -> str:
    """Canonical 'AA9 9AA' postcode text built from integer expression ``k``."""
    return (
        f"chr(CAST(65 + ({k}) % 26 AS INT)) || chr(CAST(65 + ({k}) * 7 % 26 AS INT)) || "
        f"CAST(({k}) % 10 AS STRING) || ' ' || CAST(({k}) % 9 AS STRING) || "
        f"chr(CAST(65 + ({k}) * 3 % 26 AS INT)) || chr(CAST(65 + ({k}) * 5 % 26 AS INT))"
    )


_HALF_HOUR_TEXT = (
    "CAST(CAST(ts AS DATE) AS STRING) || ' ' || lpad(CAST(hour(ts) AS STRING), 2, '0') || "
    "CASE WHEN minute(ts) >= 30 THEN ':30:00' ELSE ':00:00' END"
)

# (column, SQL expression over the source table); order = output column order
VIEWS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "raw_readings": (
        "events",
        [
            ("dataset_id", "CASE WHEN user_id % 17 = 0 THEN NULL ELSE lpad(CAST(user_id AS STRING), 10, '0') || lpad(CAST(user_id % 4 + 1 AS STRING), 2, '0') END"),
            ("dno_name", "CASE WHEN user_id % 17 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'Scottish and Southern Electricity Networks' ELSE 'National Grid Electricity Distribution' END"),
            ("dno_alias", "CASE WHEN user_id % 17 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'SSEN' ELSE 'NGED' END"),
            ("secondary_substation_id", "lpad(CAST(user_id % 50 AS STRING), 6, '0')"),
            ("secondary_substation_name", "CASE WHEN user_id % 7 = 0 THEN ' ' ELSE 'SUBSTATION ' || CAST(user_id % 50 AS STRING) END"),
            ("lv_feeder_id", "CAST(user_id % 4 + 1 AS STRING)"),
            ("lv_feeder_name", "CASE WHEN user_id % 5 = 0 THEN NULL ELSE 'FEEDER ' || CAST(user_id % 4 + 1 AS STRING) END"),
            ("substation_geo_location", "CASE WHEN user_id % 13 = 0 THEN ', ' ELSE CAST(50 + user_id % 9 AS STRING) || '.' || lpad(CAST(user_id * 37 % 1000 AS STRING), 3, '0') || ', -' || CASE WHEN user_id % 3 = 0 THEN '' ELSE CAST(user_id % 3 AS STRING) END || '.' || lpad(CAST(user_id * 53 % 1000 AS STRING), 3, '0') END"),
            ("aggregated_device_count_active", "CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(1 + event_id % 20 AS STRING) || '.5' END"),
            ("primary_consumption_active_import", "CAST(CAST(round(value * 100) AS BIGINT) AS STRING) || '.0'"),
            ("secondary_consumption_active_import", "CAST(NULL AS STRING)"),
            ("total_consumption_active_import", "CAST(CAST(round(value * 100) AS BIGINT) AS STRING) || CASE WHEN event_id % 4 = 0 THEN '.5' ELSE '.0' END"),
            ("aggregated_device_count_reactive", "'0.0'"),
            ("total_consumption_reactive_import", "'0.0'"),
            ("data_collection_log_timestamp", _HALF_HOUR_TEXT),
            ("insert_time", "CAST(ts AS STRING)"),
            ("last_modified_time", "CAST(ts AS STRING)"),
        ],
    ),
    "lookup_postcodes": (
        "customer",
        [
            ("substation_nrn", "lpad(CAST(c_custkey * 3 AS STRING), 10, '0')"),
            ("substation_geo_location", "CAST(51 + c_custkey % 7 AS STRING) || '.' || lpad(CAST(c_custkey * 7919 % 1000000 AS STRING), 6, '0') || ',-' || CAST(c_custkey % 4 AS STRING) || '.' || lpad(CAST(c_custkey * 104729 % 1000000 AS STRING), 6, '0')"),
        ],
    ),
    "lookup_model": (
        "part",
        [
            ("substation_nrn", "lpad(CAST(p_partkey * 2 AS STRING), 10, '0')"),
            ("substation_geo_location", "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(55 + p_partkey % 5 AS STRING) || '.' || lpad(CAST(p_partkey * 7907 % 1000000 AS STRING), 6, '0') || ',-' || CAST(p_partkey % 3 AS STRING) || '.' || lpad(CAST(p_partkey * 15485 % 1000000 AS STRING), 6, '0') END"),
        ],
    ),
    "mapping": (
        "customer",
        [
            ("dataset_id", "lpad(CAST(c_custkey % 3 AS STRING), 4, '0') || lpad(CAST(c_custkey % 4 AS STRING), 3, '0') || lpad(CAST(c_custkey % 5 AS STRING), 3, '0') || lpad(CAST(c_custkey % 2 + 1 AS STRING), 2, '0')"),
            ("postcode", "CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN 'ab1' "
             f"WHEN c_custkey % 4 = 0 THEN {_postcode('c_custkey % 180')} "
             f"WHEN c_custkey % 4 = 1 THEN lower({_postcode('c_custkey % 180')}) "
             f"WHEN c_custkey % 4 = 2 THEN ' ' || replace({_postcode('c_custkey % 180')}, ' ', '  ') || ' ' "
             f"ELSE replace({_postcode('c_custkey % 180')}, ' ', '') END"),
            ("primary_substation_id", "CASE WHEN c_custkey % 11 = 0 THEN lpad(CAST(c_custkey % 3 AS STRING), 5, '0') ELSE CAST(c_custkey % 3 AS STRING) END"),
            ("primary_substation_name", "'PRIMARY ' || CAST(c_custkey % 3 AS STRING)"),
            ("hv_feeder_id", "CAST(c_custkey % 4 AS STRING)"),
            ("hv_feeder_name", "'HV FEEDER ' || CAST(c_custkey % 4 AS STRING)"),
            ("secondary_substation_id", "CAST(c_custkey % 5 AS STRING)"),
            ("secondary_substation_name", "'SECONDARY ' || CAST(c_custkey % 5 AS STRING)"),
            ("lv_feeder_id", "lpad(CAST(c_custkey % 2 + 1 AS STRING), 2, '0')"),
            ("lv_feeder_name", "CAST(NULL AS STRING)"),
            ("total_mpan_count", "CAST(c_custkey % 50 AS STRING)"),
        ],
    ),
    "directory": (
        "supplier",
        [
            ("pcd", _postcode("s_suppkey")),
            # coordinates on a 1/8192-degree lattice (exact in binary), groups 1/16 degree apart
            ("lat", "CASE WHEN s_suppkey % 19 = 0 THEN '99.999999' ELSE CAST(57.125 + s_suppkey % 60 * 0.0625 + s_suppkey * 7 % 13 * 0.0001220703125 AS STRING) END"),
            ("long", "CASE WHEN s_suppkey % 23 = 0 THEN '0.000000' ELSE CAST(-2.25 - s_suppkey % 60 * 0.0625 - s_suppkey * 3 % 11 * 0.0001220703125 AS STRING) END"),
            ("pcds", _postcode("s_suppkey")),
            ("nation", "s_nationkey"),
        ],
    ),
    "model": (
        "part",
        [
            ("full_nrn", "CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey % 7 AS STRING) || '_' || CAST(p_partkey % 8 AS STRING) || '_' || CAST(p_partkey % 9 AS STRING) "
             "ELSE lpad(CAST(p_partkey % 7 AS STRING), 4, '0') || '_' || lpad(CAST(p_partkey % 8 AS STRING), 3, '0') || '_' || lpad(CAST(p_partkey % 9 AS STRING), 3, '0') END"),
            ("latitude", "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE '57.' || lpad(CAST(p_partkey % 504 * 1234 % 1000000 AS STRING), 6, '0') END"),
            ("longitude", "'-2.' || lpad(CAST(p_partkey % 504 * 4321 % 1000000 AS STRING), 6, '0')"),
            ("file_row", "p_partkey"),
            ("type", "CASE WHEN p_partkey % 9 = 0 THEN 'Primary' WHEN p_partkey % 13 = 0 THEN NULL ELSE 'Secondary' END"),
        ],
    ),
    "ssen_listing": (
        "orders",
        [
            ("url", "'raw/ssen/' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '.csv'"),
            ("storage_id", "o_orderkey"),
        ],
    ),
    "nged_listing": (
        "orders",
        [
            ("url", "CASE WHEN o_orderkey % 50 = 0 THEN 'raw/nged/notes-' || CAST(o_orderkey AS STRING) || '.txt' "
             "ELSE 'raw/nged/aggregated-smart-meter-data-lv-feeder-' || substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) || '-part' || lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0') || '.csv' END"),
            ("created", "o_orderdate"),
            ("storage_id", "o_orderkey"),
        ],
    ),
}

# raw readings as a landed file set with a few unreadable values: one file per
# day, and consumption text that is not a number on some rows
VIEWS["raw_readings_dirty"] = (
    "events",
    [(c, e) for c, e in VIEWS["raw_readings"][1] if c != "total_consumption_active_import"]
    + [
        ("total_consumption_active_import", "CASE WHEN event_id % 997 = 5 THEN 'n/a' ELSE " + dict(VIEWS["raw_readings"][1])["total_consumption_active_import"] + " END"),
        ("source_file", "'raw/' || CAST(CAST(ts AS DATE) AS STRING) || '.csv'"),
    ],
)

# three months of readings of both networks from lineitem, as files carry them: a
# third of all rows are one feeder's, some rows come in the file of days before,
# and a few consumption texts of one day are no numbers (raw_months_dirty)
_UID = "(CASE WHEN l_orderkey % 3 = 0 THEN 8 ELSE l_partkey % 397 + 1 END)"
_DAY = "CAST((l_orderkey * 7 + l_linenumber * 13) % 91 AS INT)"
_SLOT = "((l_orderkey + l_suppkey) % 48)"
_DATE = f"(DATE '2024-01-01' + {_DAY})"
_FILE_DATE = f"(DATE '2024-01-01' + {_DAY} - CASE WHEN l_orderkey % 50 = 1 THEN 3 ELSE 0 END)"
_STAMP = f"CAST({_DATE} AS STRING) || ' ' || lpad(CAST(CAST(floor({_SLOT} / 2.0) AS INT) AS STRING), 2, '0') || CASE WHEN {_SLOT} % 2 = 1 THEN ':30:00' ELSE ':00:00' END"
_SSEN = f"{_UID} % 2 = 0"
_MONTHS = [
    ("dataset_id", f"CASE WHEN {_SSEN} THEN lpad(CAST({_UID} AS STRING), 10, '0') || lpad(CAST({_UID} % 4 + 1 AS STRING), 2, '0') WHEN {_UID} % 17 = 1 THEN NULL ELSE 'N' || CAST({_UID} AS STRING) END"),
    ("dno_name", f"CASE WHEN {_SSEN} THEN 'North, East' ELSE 'South, West' END"),
    ("dno_alias", f"CASE WHEN {_SSEN} THEN 'SSEN' WHEN {_UID} % 17 = 1 THEN NULL ELSE 'NGED' END"),
    ("secondary_substation_id", f"lpad(CAST({_UID} % 50 AS STRING), 6, '0')"),
    ("secondary_substation_name", f"CASE WHEN {_UID} % 7 = 0 THEN ' ' ELSE 'SUBSTATION ' || CAST({_UID} % 50 AS STRING) END"),
    ("lv_feeder_id", f"CAST({_UID} % 4 + 1 AS STRING)"),
    ("lv_feeder_name", f"CASE WHEN {_UID} % 5 = 0 THEN NULL ELSE 'FEEDER ' || CAST({_UID} % 4 + 1 AS STRING) END"),
    ("substation_geo_location", f"CASE WHEN {_SSEN} THEN NULL WHEN {_UID} % 13 = 0 THEN ', ' ELSE CAST(50 + {_UID} % 9 AS STRING) || '.' || lpad(CAST({_UID} * 37 % 1000 AS STRING), 3, '0') || ', -2.' || lpad(CAST({_UID} * 53 % 1000 AS STRING), 3, '0') END"),
    ("aggregated_device_count_active", "CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(1 + l_linenumber AS STRING) || '.5' END"),
    ("primary_consumption_active_import", "CAST(CAST(round(l_quantity * 100) AS BIGINT) AS STRING) || '.0'"),
    ("secondary_consumption_active_import", "CAST(NULL AS STRING)"),
    ("total_consumption_active_import", "CAST(CAST(round(l_quantity * 500) AS BIGINT) AS STRING) || CASE WHEN l_linenumber % 4 = 0 THEN '.5' ELSE '.0' END"),
    ("aggregated_device_count_reactive", "'0.0'"),
    ("total_consumption_reactive_import", "'0.0'"),
    ("data_collection_log_timestamp", _STAMP),
    ("insert_time", f"CAST({_DATE} + 1 AS STRING) || ' 03:10:00'"),
    ("last_modified_time", f"CAST({_DATE} + 2 AS STRING) || ' 04:20:00'"),
    ("source_file", f"CASE WHEN {_SSEN} THEN CAST({_FILE_DATE} AS STRING) || '.csv.gz' ELSE 'aggregated-smart-meter-data-lv-feeder-' || substr(CAST({_FILE_DATE} AS STRING), 1, 7) || '-part' || lpad(CAST({_DAY} % 3 AS STRING), 4, '0') || '.csv.gz' END"),
]
VIEWS["raw_months"] = ("lineitem", _MONTHS)
VIEWS["raw_months_dirty"] = (
    "lineitem",
    [(c, f"CASE WHEN {_DAY} = 40 AND l_linenumber = 2 THEN 'n/a' ELSE {e} END" if c == "total_consumption_active_import" else e) for c, e in _MONTHS],
)

POINT_EXPRS = {
    # the embedding's first two dimensions as lon/lat offsets on a 1/65536-degree
    # lattice (exact in binary) around 57.125 N, 2.25 W; 150 groups by id
    "spark": (
        "-2.25 + round(CAST(embedding[0] AS DOUBLE) * 300) / 65536.0",
        "57.125 + round(CAST(embedding[1] AS DOUBLE) * 300) / 65536.0",
    ),
    "duckdb": (
        "-2.25 + round(CAST(embedding[1] AS DOUBLE) * 300) / 65536.0",
        "57.125 + round(CAST(embedding[2] AS DOUBLE) * 300) / 65536.0",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read as it is."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, cols = VIEWS[name]
    return table(spark, sf_dir, base).selectExpr(*[f"{expr} AS {col}" for col, expr in cols])


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "raw_readings")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed staging readings (timestamps as naive UTC)."""
    return canonical_columns(raw_readings(spark, sf_dir), timestamp_type="timestamp_ntz")


def nged_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NGED rows with the NGED header spellings (alias NGED or blank)."""
    inverse = {v: k for k, v in S.NGED_RENAMES.items()}
    raw = raw_readings(spark, sf_dir).where(F.coalesce(F.col("dno_alias"), F.lit("")) != "SSEN")
    return raw.withColumnsRenamed(inverse)


def nged_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NGED rows read the NGED way: renames, then typed."""
    return canonical_columns(rename_nged(nged_raw(spark, sf_dir)), timestamp_type="timestamp_ntz")


def ssen_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).where(F.col("dno_alias") == "SSEN")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = POINT_EXPRS["spark"]
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id AS point_id", "vec_id % 150 AS grp", f"CAST({x} AS DOUBLE) AS x", f"CAST({y} AS DOUBLE) AS y")


# ---------------------------------------------------------------------------
# DuckDB side: the same views as CTE text
# ---------------------------------------------------------------------------

_TOKENS = ", ".join("'" + t + "'" for t in S.NGED_BLANK_TOKENS)


def _blank(c: str) -> str:
    return f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END"


def _duck_view(name: str) -> str:
    base, cols = VIEWS[name]
    return f"{name} AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in cols) + f" FROM {base})"


_DUCK_TYPED = {
    "readings": "readings AS (SELECT "
    + ", ".join(f"coalesce({c}, '') AS {c}" for c in S.TEXT_COLUMNS)
    + ", "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in S.FLOAT_COLUMNS)
    + ", "
    + ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in S.TIME_COLUMNS)
    + " FROM raw_readings)",
    "months": "months AS (SELECT "
    + ", ".join(f"coalesce({c}, '') AS {c}" for c in S.TEXT_COLUMNS)
    + ", "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in S.FLOAT_COLUMNS)
    + ", "
    + ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in S.TIME_COLUMNS)
    + ", source_file FROM raw_months)",
    "nged_readings": "nged_readings AS (SELECT * FROM readings WHERE dno_alias <> 'SSEN')",
    "ssen_readings": "ssen_readings AS (SELECT * FROM readings WHERE dno_alias = 'SSEN')",
    "nged_staging": "nged_staging AS (SELECT "
    + ", ".join(
        (f"coalesce({_blank(c)}, 'NGED') AS {c}" if c == "dno_alias" else f"{_blank(c)} AS {c}")
        if c in S.NGED_BLANK_COLUMNS
        else c
        for c in S.CANONICAL_COLUMNS
    )
    + " FROM nged_readings)",
    "merged_lookup": "merged_lookup AS (SELECT substation_nrn, coalesce(b.substation_geo_location, a.substation_geo_location) AS substation_geo_location "
    "FROM lookup_postcodes a FULL OUTER JOIN lookup_model b USING (substation_nrn))",
    "ssen_staging": "ssen_staging AS (SELECT "
    + ", ".join(("l.substation_geo_location AS substation_geo_location" if c == "substation_geo_location" else f"r.{c} AS {c}") for c in S.CANONICAL_COLUMNS)
    + " FROM ssen_readings r LEFT JOIN merged_lookup l ON substr(r.dataset_id, 1, 10) = l.substation_nrn)",
    "staging": "staging AS (SELECT * FROM nged_staging UNION ALL SELECT * FROM ssen_staging)",
    "points": "points AS (SELECT vec_id AS point_id, vec_id % 150 AS grp, "
    + f"CAST({POINT_EXPRS['duckdb'][0]} AS DOUBLE) AS x, CAST({POINT_EXPRS['duckdb'][1]} AS DOUBLE) AS y FROM embeddings)",
}

_DEPENDS = {
    "readings": ["raw_readings"],
    "months": ["raw_months"],
    "nged_readings": ["readings"],
    "ssen_readings": ["readings"],
    "nged_staging": ["nged_readings"],
    "merged_lookup": ["lookup_postcodes", "lookup_model"],
    "ssen_staging": ["ssen_readings", "merged_lookup"],
    "staging": ["nged_staging", "ssen_staging"],
}


def duck_with(*names: str) -> str:
    """``WITH`` clause defining the named views (and what they need) for DuckDB."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [_DUCK_TYPED[n] if n in _DUCK_TYPED else _duck_view(n) for n in order]
    return "WITH " + ",\n".join(parts) + "\n"


#: files a landing task has open at once, and bytes of a file it holds back
OPEN_FILES, HELD = 200, 1 << 18


def land_csv(df: DataFrame, folder: str, name_col: str = "source_file", swap: bool = True, order: str | None = None) -> None:
    """Write ``df``'s text columns as the CSV files a source would have put there,
    a file per name in ``name_col``. With ``swap`` every other file has its columns
    the other way round, as nothing promises their order. ``order``: a number
    column (not written) that sorts a file's rows; a name that ends in .gz is
    compressed.

    A file may be larger than a task's memory: each task streams its rows, as
    lines, into pieces beside ``folder``, one per name, and a file is its header
    and its pieces one after the other (gzip members put together are a gzip
    file). Rows are shuffled only where ``order`` asks for it."""
    columns = [c for c in df.columns if c not in (name_col, order)]
    pieces = f"{folder.rstrip('/')}-pieces"
    options = {"escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

    def packed(name: str, data: bytes) -> bytes:
        return gzip.compress(data, 6) if name.endswith(".gz") else data

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (name, line): a piece of each name."""
        ctx = TaskContext.get()
        fs, base = pafs.FileSystem.from_uri(pieces)
        files: dict[str, tuple] = {}  # name -> stream, lines held back
        made: list[dict] = []

        def flush(name: str) -> None:
            out, held = files[name]
            if held:
                out.write(packed(name, b"".join(held)))
                held.clear()

        def close(name: str) -> None:
            flush(name)
            files.pop(name)[0].close()

        for b in batches:
            for part in _by_name(b):
                name = part.column(0)[0].as_py()
                if name not in files:
                    if len(files) >= OPEN_FILES:
                        close(next(iter(files)))
                    piece = f"{ctx.partitionId():09d}-{ctx.taskAttemptId()}-{len(made):06d}"  # attempts never share one
                    files[name] = (fs.open_output_stream(f"{base}/{piece}", compression=None), [])
                    made.append({"name": name, "piece": piece})
                held = files[name][1]
                held.append("\n".join([*part.column(1).to_pylist(), ""]).encode())
                if sum(map(len, held)) >= HELD:
                    flush(name)
        for name in list(files):
            close(name)
        if made:
            yield pa.RecordBatch.from_pylist(made)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, base), (there, target) = pafs.FileSystem.from_uri(pieces), pafs.FileSystem.from_uri(folder)
        for b in batches:
            for r in b.to_pylist():
                head = io.StringIO()
                csv.writer(head, lineterminator="\n").writerow(columns[::-1] if swap and zlib.crc32(r["name"].encode()) % 2 else columns)
                with there.open_output_stream(f"{target}/{r['name']}", compression=None) as out:
                    out.write(packed(r["name"], head.getvalue().encode()))
                    for p in r["pieces"]:
                        with fs.open_input_stream(f"{base}/{p}", compression=None) as piece:
                            while block := piece.read(1 << 20):
                                out.write(block)
            yield b.select(["name"])

    _folder(folder)
    _folder(pieces)
    line = F.to_csv(F.struct(*columns), options)
    if swap:
        line = F.when(F.crc32(F.col(name_col).cast("binary")) % 2 == 1, F.to_csv(F.struct(*columns[::-1]), options)).otherwise(line)
    if order:
        by = F.col(order).asc_nulls_last()
        df = df.repartitionByRange(name_col, by).sortWithinPartitions(name_col, by)
    made = df.select(F.col(name_col).alias("name"), line.alias("line")).mapInArrow(write, "name string, piece string")
    files = made.groupBy("name").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    files.repartition("name").mapInArrow(join, "name string").write.format("noop").mode("overwrite").save()
    fs, base = pafs.FileSystem.from_uri(pieces)
    fs.delete_dir(base)


def _by_name(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch's rows by its first column, their order kept within a name."""
    codes = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    at = np.argsort(codes, kind="stable")
    cut = np.flatnonzero(np.diff(codes[at])) + 1
    for rows in np.split(at, cut):
        if len(rows):
            yield batch.take(pa.array(rows))


def _folder(path: str) -> None:
    fs, base = pafs.FileSystem.from_uri(path)
    fs.create_dir(base, recursive=True)


def nged_blank_columns_spark(df: DataFrame) -> DataFrame:
    return df.withColumns({c: blank_to_null(c) for c in S.NGED_BLANK_COLUMNS})
