"""JB6 over every half hour together: nothing is left out but a half hour's outlier."""

import datetime as dt
from collections import defaultdict

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from meterflow.plans import analytics
from meterflow.queries import REGISTRY

SCHEMA = (
    "data_collection_log_timestamp timestamp_ntz, secondary_substation_unique_id string, geometry struct<x: double, y: double>, "
    "total_consumption_active_import long, aggregated_device_count_active long"
)
HERE, THERE, NOWHERE = (-2.1, 51.5), (-2.2, 51.6), (float("nan"), float("nan"))


def at(slot: int) -> dt.datetime:
    return dt.datetime(2024, 2, 29, 23) + slot * dt.timedelta(minutes=30)


def test_outliers_are_cut_by_half_hour_and_the_rest_is_summed(spark):
    rows = [
        (at(0), "A", HERE, 12000, 3), (at(1), "A", HERE, 15000, 4), (at(2), "A", HERE, 19999, 5),  # 46,999 in all
        (at(3), "A", HERE, 12000, 3), (at(3), "A", HERE, 8000, 2),  # two feeders, 20,000 in one half hour
        (at(0), "A", THERE, 100, None), (at(2), "A", THERE, None, 7),  # another place; no consumption in a half hour
        (at(0), "B", NOWHERE, 9000, 1), (at(1), "B", NOWHERE, 18000, 1),
        (at(1), "C", HERE, 25000, 9), (at(1), None, HERE, 10, 1),
    ]
    readings = spark.createDataFrame(rows, SCHEMA)

    def found(df):
        return {(r[0], str(tuple(r["geometry"]))): (r["total_consumption_active_import"], r["aggregated_device_count_active"]) for r in df.collect()}

    whole = {("A", str(HERE)): (46.999, 12), ("A", str(THERE)): (0.1, None), ("B", str(NOWHERE)): (27.0, 2)}
    assert found(analytics.consumption_map(readings)) == whole
    assert found(analytics.consumption_map(readings, period=at(1))) == {("A", str(HERE)): (15.0, 4), ("B", str(NOWHERE)): (18.0, 1)}
    assert analytics.consumption_map(readings, per_period=True).count() == 6


def test_the_query_reads_every_half_hour(spark, tmp_path):
    keys = range(1, 1201)
    tables = {
        "lineitem": {
            "l_orderkey": [*keys], "l_partkey": [k * 31 % 9 for k in keys], "l_suppkey": [k * 7 % 10 for k in keys], "l_linenumber": [k % 7 + 1 for k in keys],
            "l_quantity": [float(k * 11 % 50 + 1) for k in keys],
        },
        "customer": {"c_custkey": [2, 4, 6]},
        "part": {"p_partkey": [3, 4, 5]},
    }
    con = duckdb.connect()
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet')")
    by_slot, totals = defaultdict(int), defaultdict(int)
    for r in REGISTRY["published_roundtrip"].build(spark, str(tmp_path)).collect():
        place = (r["secondary_substation_unique_id"], r["longitude"], r["latitude"])
        by_slot[(*place, r["data_collection_log_timestamp"])] += r["total_consumption_active_import"]
    for (*place, _), wh in by_slot.items():
        if wh < 20000:
            totals[tuple(place)] += wh
    assert len({slot for *_, slot in by_slot}) > 500 and max(totals.values()) > 20000 <= max(by_slot.values())
    query = REGISTRY["substation_totals"]
    columns = ["secondary_substation_unique_id", "longitude", "latitude", "total_consumption_active_import"]
    got = query.build(spark, str(tmp_path)).select(*columns).collect()
    assert {tuple(r[:3]): r[3] for r in got} == {place: wh / 1000 for place, wh in totals.items()}
    assert {tuple(r) for r in got} == set(con.execute(f"SELECT {', '.join(columns)} FROM ({query.oracle})").fetchall())
