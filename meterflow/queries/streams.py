"""Streaming queries: the events table as a file stream, read the way raw
readings arrive, de-duplicated day by day without a limit on lateness."""

from __future__ import annotations

from ..sources import readers as R
from ..sources import testdata as TD
from ..streaming import ingest as ST
from .registry import register

KEYS = ["data_collection_log_timestamp", "dno_alias", "secondary_substation_id", "lv_feeder_id"]


@register(
    "ingest_stream_rows",
    "IN8 (file stream, de-duplication by day)",
    TD.duck_with("readings") + "SELECT DISTINCT " + ", ".join(KEYS) + " FROM readings",
)
def ingest_stream_rows(spark, sf):
    path = f"{sf.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    # a file source watches a folder; the glob keeps it to the events table
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf.rstrip("/"))
    base, cols = TD.VIEWS["raw_readings"]
    raw = stream.selectExpr(*[f"{expr} AS {col}" for col, expr in cols])
    typed = R.canonical_columns(raw, timestamp_type="timestamp_ntz")
    chk, out = ST.scratch_paths(spark, "stream-rows")
    ST.dedupe_stream(typed.select(*KEYS), KEYS, out, chk)
    return spark.read.schema(typed.select(*KEYS).schema).parquet(out).select(*KEYS)
