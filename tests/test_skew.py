"""A key holding a third of all rows: results stay exact and whole."""

import datetime as dt

from pyspark.sql import functions as F

from meterflow.operators import aggregates as A
from meterflow.operators import windows as W


def skewed(spark, n=30000):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        feeder = "HOT" if hot else f"F{i % 997}"
        ts = base + dt.timedelta(minutes=30 * ((i // 3) % 500 if hot else i % 200))
        rows.append((feeder, ts, float(i % 101), f"d{i % 7}"))
    return spark.createDataFrame(rows, "lv_feeder_unique_id string, data_collection_log_timestamp timestamp, total_consumption_active_import double, dataset_id string").repartition(16)


def test_dedupe_hot_key_exact(spark):
    df = skewed(spark).withColumn("aggregated_device_count_active", F.lit(1.0))
    out = W.dedupe_readings(df)
    # one row per (ts, feeder); the kept row is the smallest by (dataset_id, consumption, ...)
    want = (
        df.groupBy("data_collection_log_timestamp", "lv_feeder_unique_id")
        .agg(F.min(F.struct("dataset_id", "total_consumption_active_import")).alias("m"))
        .select("data_collection_log_timestamp", "lv_feeder_unique_id", "m.dataset_id", "m.total_consumption_active_import")
    )
    got = out.select("data_collection_log_timestamp", "lv_feeder_unique_id", "dataset_id", "total_consumption_active_import")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert out.where("lv_feeder_unique_id = 'HOT'").count() == 500


def test_first_by_is_map_side_aggregate(spark):
    df = skewed(spark)
    plan = W.first_by(df, ["lv_feeder_unique_id"], ["data_collection_log_timestamp"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min(" in plan  # combined before the shuffle


def test_stats_with_hot_month(spark):
    df = skewed(spark)
    st = A.partition_stats(df.withColumnRenamed("lv_feeder_unique_id", "dataset_id_feeder").withColumn("dataset_id", F.col("dataset_id_feeder")), "SSEN")
    rows = st.collect()
    assert sum(r.row_count for r in rows) == 30000
    assert [(r.row_count, r.nunique_feeders) for r in rows] == [(30000, 998)]  # one month, 997 feeders + the hot one
