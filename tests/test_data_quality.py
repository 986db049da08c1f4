"""Exact percentiles of hot groups, one parse of raw files, states of files."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.operators import quality as Q
from meterflow.plans import month_stats as MS


@pytest.mark.parametrize("by", [["g"], [], ["g", "h"]])
def test_percentiles_are_those_of_numpy(spark, by):
    rnd = random.Random(3)
    rows = [("hot", i % 2, float(rnd.choice([1, 2, 2, 3, 1e9, rnd.uniform(-5, 5)]))) for i in range(4000)]
    rows += [("one", 0, 7.0), ("same", 0, 4.0), ("same", 0, 4.0), ("nulls", 0, None), (None, 0, 1.0), (None, 0, 2.0), ("hot", 0, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(5)
    shares = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {tuple(r[c] for c in by): r for r in Q.exact_percentiles(df, "v", shares, by, "most").collect()}
    groups = {}
    for g, h, v in rows:
        groups.setdefault(tuple({"g": g, "h": h}[c] for c in by), []).append(v)
    assert got.keys() == groups.keys()
    for k, values in groups.items():
        there = [v for v in values if v is not None]
        for name, share in shares.items():
            assert got[k][name] == (pytest.approx(np.percentile(there, 100 * share)) if there else None)
        assert got[k].most == (max(there) if there else None)


def test_no_percentile_buffer(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))], "g string, data_collection_log_timestamp timestamp_ntz, insert_time timestamp_ntz")
    plan = Q.insert_lag_profile(df, ["g"], exact=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "source_file string, month string, feeder string, station string").withColumn("month", F.to_date("month"))


NAMES = ["feeders", "stations"]


def keys():
    return {"feeders": F.col("feeder"), "stations": F.col("station")}


def figures(spark, root):
    return {str(r.month): (r.row_count, r.nunique_feeders, r.nunique_stations) for r in MS.month_stats(spark, root, NAMES).collect()}


def plain(rows):
    out = {}
    for _, m, f, s in rows:
        n, fs, ss = out.setdefault(m, [0, set(), set()])
        out[m][0] = n + 1
        fs.add(f)
        ss.add(s)
    return {m: (n, len(fs), len(ss)) for m, (n, fs, ss) in out.items()}


def test_states_of_files(spark, tmp_path):
    rnd, root = random.Random(9), str(tmp_path / "stats")
    months = ["2024-01-01", "2024-02-01", "2024-03-01"]

    def file(name, n):
        return [(name, rnd.choice(months[:2]) if name == "b" else months["abc d".index(name[0]) % 3], rnd.choice([None, *[f"f{i}" for i in range(60)]]), f"s{rnd.randrange(9)}") for _ in range(n)]

    landed = {n: file(n, 80) for n in ("a", "b", "c", "a/x y=1.csv")}
    for n, rows in landed.items():  # batch by batch
        MS.update_stats(spark, root, rows_of(spark, rows), keys())
    assert figures(spark, root) == plain([r for rows in landed.values() for r in rows])
    landed["b"] = file("b", 30)  # lands anew, with other rows
    MS.update_stats(spark, root, rows_of(spark, landed["b"]), keys(), ["b"])
    assert figures(spark, root) == plain([r for rows in landed.values() for r in rows])
    landed["a"] = []  # is rejected now
    MS.update_stats(spark, root, rows_of(spark, []), keys(), ["a"])
    assert figures(spark, root) == plain([r for rows in landed.values() for r in rows])
    many = [("z", months[2], f"n{i}", "s1") for i in range(70_000)]  # more keys than a bitmap holds
    MS.update_stats(spark, root, rows_of(spark, many), keys())
    assert figures(spark, root) == plain([r for rows in [*landed.values(), many] for r in rows])


def test_a_landed_day_is_the_only_one_read(spark, tmp_path):
    """An update reads its own rows; month figures read states, not rows."""
    root = str(tmp_path / "stats")
    MS.update_stats(spark, root, rows_of(spark, [("a", "2024-01-01", "f1", "s1")]), keys())
    gone = rows_of(spark, [("b", "2024-01-01", "f2", "s1")])
    MS.update_stats(spark, root, gone, keys())
    assert all("/stats/" in f for f in MS.month_stats(spark, root, NAMES).inputFiles())
    assert figures(spark, root) == {"2024-01-01": (2, 2, 1)}


def test_raw_files_are_parsed_once(spark, tmp_path):
    raw = str(tmp_path / "raw")
    from fixtures import ssen_daily_files

    ssen_daily_files(raw, 2024, 2, days=[1, 2])
    ssen_daily_files(raw, 2024, 2, days=[3], consumption="n/a")
    from meterflow.plans import jobs as JB

    out = JB.ingest_raw(spark, raw, "SSEN", stats_root=str(tmp_path / "stats"))
    for name in ("good", "bad_files", "stats"):
        plan = out[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" in plan and "csv" not in plan.lower().replace(".csv", "")
    assert [(str(r.month), r.row_count, r.nunique_feeders) for r in MS.month_stats(spark, str(tmp_path / "stats"), ["feeders"]).collect()] == [("2024-02-01", 40, 4)]
    ssen_daily_files(raw, 2024, 2, days=[3])  # lands anew, readable
    JB.ingest_raw(spark, f"{raw}/2024-02-03.csv.gz", "SSEN", stats_root=str(tmp_path / "stats"))
    assert MS.month_stats(spark, str(tmp_path / "stats"), ["feeders"]).first().row_count == 60
