"""Cursor and rebuild logic (IN1-IN6), listings (SC9-SC14)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from meterflow.plans import incremental as IN
from meterflow.plans import jobs as JB
from meterflow.sources import manifests as M
from meterflow.streaming import ingest as ST

from fixtures import ssen_daily_files


def ssen_listing(spark, tmp_path, days):
    doc = {"objects": [{"downloadLink": f"https://files.example/lv/{d}.csv", "etag": d} for d in days]}
    path = tmp_path / "ssen.json"
    path.write_text(json.dumps(doc))
    return M.file_manifest_ssen(spark, str(path))


def test_ssen_cursor(spark, tmp_path):
    """The cursor is a file name: what sorts behind it is new, a gap or not."""
    days = ["2025-01-09", "2024-12-30", "2025-01-03", "2024-12-31", "2025-01-02"]  # the portal's order; 1 January never landed
    man = ssen_listing(spark, tmp_path, days)
    assert [r.filename[:10] for r in man.collect()] == sorted(days)
    for cursor in ["", *sorted(days), "2025-01-01", "2026"]:
        new = {r.filename[:10] for r in IN.new_files_by_name(man, f"{cursor}.csv" if cursor else "").collect()}
        assert new == {d for d in days if d > cursor}


def test_nged_created_cursor(spark, tmp_path):
    """The cursor is the time of creation, whatever month a part belongs to."""
    name = "https://files.example/aggregated-smart-meter-data-lv-feeder-{}-part{:04d}.csv".format
    created = {("2025-03", 0): "2025-04-11T06:00:00", ("2025-03", 1): "2025-04-11T06:30:00", ("2025-02", 4): "2025-04-12T00:00:00"}
    res = [{"url": name(*k), "created": v} for k, v in created.items()] + [{"url": "https://files.example/terms.pdf", "created": "2025-05-01T00:00:00"}]
    path = tmp_path / "nged.json"
    path.write_text(json.dumps({"resources": res}))
    man = M.file_manifest_nged(spark, str(path))
    assert man.count() == len(created)
    for cursor, n in (("2025-04-11 05:59:59", 3), ("2025-04-11 06:00:00", 2), ("2025-04-11 23:00:00", 1), ("2025-04-12 00:00:00", 0)):
        assert IN.new_files_by_created(man, cursor).count() == n
    assert M.part_files_for_month(man, "2025-03-01").count() == 2


def test_affected_months_and_relanding(spark):
    log = spark.createDataFrame(
        [(1, "https://f/2024-02-12.csv"), (2, "https://f/2024-02-13.csv"), (3, "https://f/2024-03-01.csv"), (4, "https://f/2024-02-13.csv")],
        "storage_id long, url string",
    )
    months = [str(r.month) for r in IN.affected_months(log, "SSEN", None).collect()]
    assert months == ["2024-02-01", "2024-03-01"]
    assert [str(r.month) for r in IN.affected_months(log, "SSEN", 3).collect()] == ["2024-02-01"]
    assert IN.next_cursor(log, 3).first().cursor == 4


def test_changed_source(spark):
    res = spark.createDataFrame([("a", dt.datetime(2024, 5, 1)), ("b", dt.datetime(2024, 5, 1))], "id string, last_modified timestamp")
    cur = spark.createDataFrame([("a", dt.datetime(2024, 6, 1))], "id string, cursor timestamp")
    assert [r.id for r in IN.changed_sources(res, cur).collect()] == ["b"]


def test_stale_partitions_variants(spark):
    T = dt.datetime
    ins = spark.createDataFrame(
        [("2024-01", "raw", "d1", T(2024, 2, 5), False), ("2024-01", "lookup", "all", T(2024, 3, 1), False),
         ("2024-02", "raw", "d1", T(2024, 3, 2), False), ("2024-03", "lookup", "all", T(2024, 4, 1), True)],
        "partition string, asset string, input_partition string, updated_at timestamp, in_progress boolean",
    )
    outs = spark.createDataFrame([("2024-01", T(2024, 2, 10)), ("2024-02", T(2024, 3, 5))], "partition string, built_at timestamp")
    req = spark.createDataFrame([("2024-01", "raw", "d1"), ("2024-02", "raw", "d1"), ("2024-02", "raw", "d2")], "partition string, asset string, input_partition string")
    strict = {r.partition for r in IN.stale_partitions(ins, outs, req).collect()}
    assert strict == {"2024-01"}  # 2024-02 not newer; 2024-03 in progress
    raw_ignored = {r.partition for r in IN.stale_partitions(ins, outs, req, ignore_assets=["raw"]).collect()}
    assert raw_ignored == {"2024-01"}
    tolerant = {r.partition for r in IN.stale_partitions(ins, outs, req, tolerate_missing=True, latest_only=True).collect()}
    assert tolerant == set()


def test_missing_days(spark):
    months = spark.createDataFrame([(dt.date(2024, 2, 1),)], "month date")
    man = spark.createDataFrame([(f"2024-02-{d:02d}.csv",) for d in range(1, 30) if d != 14], "filename string")
    miss = [r.filename for r in M.missing_daily_files(months, man).collect()]
    assert miss == ["2024-02-14.csv.gz"]


def test_stream_ingest_rebuilds_touched_months(spark, tmp_path):
    landing = str(tmp_path / "landing")
    chk = str(tmp_path / "chk")
    ssen_daily_files(landing, 2024, 2, days=[12, 13])
    seen = []

    def rebuild(months):
        seen.append(months)
        JB.build_ssen_months(spark, landing, spark.createDataFrame([], "substation_nrn string, substation_geo_location string"),
                             str(tmp_path / "st"), months)

    ST.ingest_stream(spark, landing, rebuild, checkpoint=chk)
    assert seen == [["2024-02-01"]]
    ST.ingest_stream(spark, landing, rebuild, checkpoint=chk)  # nothing new
    assert seen == [["2024-02-01"]]
    ssen_daily_files(landing, 2024, 3, days=[1])
    ssen_daily_files(landing, 2024, 2, days=[14])
    ST.ingest_stream(spark, landing, rebuild, checkpoint=chk)
    assert seen[-1] == ["2024-02-01", "2024-03-01"]
    st = spark.read.parquet(str(tmp_path / "st")).groupBy("month").count().collect()
    assert {str(r.month): r["count"] for r in st} == {"2024-02-01": 60, "2024-03-01": 20}  # incremental = full rebuild


def test_files_without_a_month_in_their_name(spark, tmp_path):
    """The timestamp is found by each file's own header; a file without it fails by name."""
    import gzip

    import pytest

    from meterflow import schemas as S

    landing, seen = tmp_path / "landing", []
    landing.mkdir()

    def put(name, columns, stamp):
        with gzip.open(landing / name, "wt") as f:
            f.write(",".join(columns) + "\n" + ",".join(stamp if c == "data_collection_log_timestamp" else "2020-01-01 00:00:00" for c in columns) + "\n")

    put("one.csv.gz", S.SSEN_CSV_COLUMNS, "2024-02-12 00:30:00")
    put("two.csv.gz", S.SSEN_CSV_COLUMNS[::-1], "2024-04-01 00:30:00")  # columns moved
    put("2024-06-30.csv.gz", S.SSEN_CSV_COLUMNS[::-1], "2024-07-01 00:00:00")  # counts for its name's month
    ST.ingest_stream(spark, str(landing), seen.append, checkpoint=str(tmp_path / "chk"))
    assert seen == [["2024-02-01", "2024-04-01", "2024-06-01"]]
    put("three.csv.gz", [c for c in S.SSEN_CSV_COLUMNS if c != "data_collection_log_timestamp"], "")
    with pytest.raises(Exception, match="three.csv.gz.*data_collection_log_timestamp"):
        ST.ingest_stream(spark, str(landing), seen.append, checkpoint=str(tmp_path / "chk"))
