"""End-to-end month builds (JB1-JB4) on generated raw files."""

import glob
import json
import math
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meterflow import schemas as S
from meterflow.operators import joins as J
from meterflow.plans import jobs as JB
from meterflow.sources import readers as R

from fixtures import NGED_PER_DAY, SSEN_PER_DAY, nged_part_files, ssen_daily_files, ssen_rows, write_csv

LOOKUP_SCHEMA = "substation_nrn string, substation_geo_location string"


def lookup(spark):
    a = spark.createDataFrame([("5310024417", "51.204,-1.753"), ("5310024862", "51.377,-1.418")], LOOKUP_SCHEMA)
    b = spark.createDataFrame([("5310024417", "51.311,-1.662")], LOOKUP_SCHEMA)
    return J.merged_location_lookup(a, b)


def files_in_order(folder):
    return sorted(glob.glob(f"{folder}/*.parquet"))


def assert_sorted(folder, cols):
    rows = []
    for f in files_in_order(folder):
        t = pq.read_table(f)
        rows += list(zip(*[t.column(c).to_pylist() for c in cols]))
    key = [tuple((v is None, v) for v in r) for r in rows]
    assert key == sorted(key)
    return len(rows)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    ssen_dir, nged_dir = f"{root}/raw/ssen", f"{root}/raw/nged"
    ssen_daily_files(ssen_dir, 2024, 2)
    nged_part_files(nged_dir, 2024, 1, extra_next_month=True)
    nged_part_files(nged_dir, 2024, 2)
    staging, published = f"{root}/staging", f"{root}/published"
    ssen = JB.build_ssen_months(spark, ssen_dir, lookup(spark), staging, ["2024-02-01", "2024-03-01"])
    nged = JB.build_nged_months(spark, nged_dir, staging, ["2024-01-01", "2024-02-01"])
    comb = JB.build_combined_months(spark, staging, published, ["2024-01-01", "2024-02-01"])
    return {"root": root, "staging": staging, "published": published, "ssen": ssen, "nged": nged, "combined": comb}


def test_ssen_month_rows_and_locations(spark, built):
    df = spark.read.parquet(built["staging"]).where("dno = 'SSEN' AND month = DATE'2024-02-01'")
    assert df.count() == SSEN_PER_DAY * 29
    locs = {r.secondary_substation_id: r.substation_geo_location for r in df.select("secondary_substation_id", "substation_geo_location").distinct().collect()}
    assert locs == {"417": "51.311,-1.662", "862": "51.377,-1.418", "950": None}
    assert not glob.glob(f"{built['staging']}/dno=SSEN/month=2024-03-01")  # no input, no output
    stats = {str(r.month): (r.row_count, r.nunique_feeders) for r in built["ssen"].stats.collect()}
    assert stats == {"2024-02-01": (580, 4)}


def assert_files_sorted_by_day(folder, cols):
    total = 0
    for f in files_in_order(folder):
        t = pq.read_table(f)
        rows = list(zip(*[t.column(c).to_pylist() for c in cols]))
        key = [tuple((v is None, v) for v in r) for r in rows]
        assert key == sorted(key)  # each file sorted; small days may share a file (AQE coalesces)
        total += len(rows)
    return total


def test_ssen_month_sorted(built):
    n = assert_files_sorted_by_day(f"{built['staging']}/dno=SSEN/month=2024-02-01", ["data_collection_log_timestamp", "dno_alias", "secondary_substation_id", "lv_feeder_id"])
    assert n == 580


def test_nged_month_cleaning_and_stats(spark, built):
    df = spark.read.parquet(built["staging"]).where("dno = 'NGED' AND month = DATE'2024-01-01'")
    assert df.count() == 248
    blank = df.where("secondary_substation_id = '640022'").first()
    assert blank.dataset_id is None and blank.secondary_substation_name is None and blank.lv_feeder_name is None
    assert blank.substation_geo_location is None and blank.dno_alias == "NGED"
    stats = {str(r.month): (r.row_count, r.nunique_feeders) for r in built["nged"].stats.collect()}
    assert stats["2024-01-01"] == (249, 4)  # counted before the month filter, as published
    outside = {str(r.month): r.rows_outside_month for r in built["nged"].outside.collect()}
    assert outside == {"2024-01-01": 1}
    assert assert_files_sorted_by_day(f"{built['staging']}/dno=NGED/month=2024-01-01", ["data_collection_log_timestamp", "dno_alias", "secondary_substation_id", "lv_feeder_id"]) == 248


def test_combined_month(spark, built):
    pub = R.read_published(spark, built["published"])
    feb = pub.where("month = DATE'2024-02-01'")
    assert feb.count() == (SSEN_PER_DAY + NGED_PER_DAY) * 29
    stats = {str(r.month): (r.row_count, r.nunique_feeders, r.nunique_substations) for r in built["combined"].stats.collect()}
    assert stats["2024-02-01"] == (812, 8, 6)
    assert stats["2024-01-01"] == (248, 4, 3)
    assert pub.columns[:8] == S.PUBLISHED_COLUMNS
    r = feb.where("lv_feeder_unique_id = 'SSEN-531002441703'").first()
    assert (r.aggregated_device_count_active, r.total_consumption_active_import) == (8, 642)  # 7.5 -> 8, 641.5 -> 642: to even
    n = feb.where("dno_alias = 'NGED'").first()
    assert (n.aggregated_device_count_active, n.total_consumption_active_import) == (22, 1180)  # 1180.5 -> 1180
    ids = {(x.secondary_substation_unique_id, x.lv_feeder_unique_id) for x in feb.where("dno_alias = 'NGED'").collect()}
    assert ("NGED-771203", "NGED-771203-4") in ids


def month_folder(spark, root, month):
    """Where the files lie that the index names for a month."""
    named = {os.path.dirname(r.file) for r in R.published_files(spark, root).where(F.col("month") == month).collect()}
    assert len(named) == 1
    return f"{root}/files/{named.pop()}"


def test_geoparquet_files(spark, built):
    folder = month_folder(spark, built["published"], "2024-02-01")
    files = files_in_order(folder)
    meta = pq.read_schema(files[0]).metadata
    geo = json.loads(meta[b"geo"])
    assert geo["primary_column"] == "geometry" and geo["columns"]["geometry"]["encoding"] == "point"
    t = pq.read_table(files[0])
    assert str(t.schema.field("data_collection_log_timestamp").type) == "timestamp[ms, tz=UTC]"
    rows = 0
    empty = 0
    for f in files:
        tt = pq.read_table(f)
        rows += tt.num_rows
        for g in tt.column("geometry").to_pylist():
            assert g is not None
            if math.isnan(g["x"]):
                empty += 1
    assert rows == 812 and empty == 29 * (5 + 2)  # SSEN 950 (no lookup) and NGED blank location
    assert assert_sorted(folder, S.PUBLISHED_SORT) == 812


def test_rebuild_replaces_only_its_month(spark, built):
    before = spark.read.parquet(built["staging"]).where("dno = 'NGED' AND month = DATE'2024-01-01'").count()
    JB.build_nged_months(spark, f"{built['root']}/raw/nged", built["staging"], ["2024-02-01"])
    after = spark.read.parquet(built["staging"]).where("dno = 'NGED'").groupBy("month").count().collect()
    assert {str(r.month): r["count"] for r in after} == {"2024-01-01": before, "2024-02-01": NGED_PER_DAY * 29}


def test_one_dno_odd_days(spark, tmp_path):
    root = str(tmp_path)
    ssen_daily_files(f"{root}/raw", 2024, 1, days=range(3, 31, 4))
    JB.build_ssen_months(spark, f"{root}/raw", lookup(spark), f"{root}/st", ["2024-01-01"])
    res = JB.build_combined_months(spark, f"{root}/st", f"{root}/pub", ["2024-01-01"])
    assert res.stats.first().row_count == SSEN_PER_DAY * 7


def test_no_input_no_output(spark, tmp_path):
    res = JB.build_ssen_months(spark, str(tmp_path / "none"), lookup(spark), str(tmp_path / "st"), ["2024-05-01"])
    assert res.stats is None and not os.path.exists(tmp_path / "st")


def test_bad_file_rejected_whole(spark, tmp_path):
    folder = str(tmp_path / "raw")
    ssen_daily_files(folder, 2024, 2, days=[5])
    ssen_daily_files(folder, 2024, 2, days=[6], consumption="n/a")
    out = JB.ingest_raw(spark, folder, "SSEN")
    bad = [r.source_file for r in out["bad_files"].collect()]
    assert len(bad) == 1 and bad[0].endswith("2024-02-06.csv.gz")
    stats = out["stats"].collect()
    assert len(stats) == 1 and stats[0].row_count == SSEN_PER_DAY and stats[0].nunique_feeders == 4
    assert {r.name for r in out["schema"].collect()} == set(S.CANONICAL_COLUMNS)


def test_read_readings_pushes_filters_and_prunes_months(spark, built):

    df = R.read_readings(
        spark,
        built["published"],
        columns=["secondary_substation_unique_id", "total_consumption_active_import", "geometry"],
        filters=[("data_collection_log_timestamp", "=", "2024-02-10 04:30:00")],
        bbox=(-3.0, 50.0, 0.0, 54.0),
    )
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    scan = plan[plan.index("Scan parquet"):]
    assert "PartitionFilters: [isnotnull(month" in scan and "2024-02-01" in scan  # month folders pruned
    assert "EqualTo(data_collection_log_timestamp" in scan  # timestamp predicate reaches the reader
    assert "geometry.x" in scan and "geometry.y" in scan  # so does the bbox
    assert "dataset_id" not in scan.split("ReadSchema:")[1].split("\n")[0]  # unused columns pruned
    rows = df.collect()
    assert len(rows) == 6  # NGED: three feeders with a point; SSEN: 417 twice and 862


def test_lookup_join_is_broadcast_and_guarded(spark, tmp_path):
    from meterflow.sinks import files as SINK2

    lk = lookup(spark)
    SINK2.write_location_lookup(lk, str(tmp_path / "lookup"))
    ssen_daily_files(str(tmp_path / "raw"), 2024, 2, days=[1])
    readings = R.read_daily_readings(spark, str(tmp_path / "raw"))
    joined = J.attach_locations(readings, R.read_location_lookup(spark, str(tmp_path / "lookup")))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # readings are not shuffled
    dup = lk.unionByName(lk)
    with pytest.raises(ValueError, match="not unique"):
        JB.build_ssen_months(spark, str(tmp_path / "raw"), dup, str(tmp_path / "st"), ["2024-02-01"])


def test_read_staging_month_and_late_rows(spark, built):
    from meterflow.operators import quality as Q

    feb = R.read_staging_month(spark, built["staging"], "SSEN", "2024-02")
    assert feb.count() == 580 and "month" not in feb.columns
    tagged = spark.read.parquet(built["staging"]).where("dno = 'NGED'")
    assert Q.late_rows(tagged.withColumnRenamed("month", "file_month")).count() == 0  # FI3 already dropped them


def test_feeder_extract_sample(spark, built):
    from meterflow.plans.analytics import feeder_extract

    pub = R.read_published(spark, built["published"])
    a = feeder_extract(pub, n=3, seed=7).collect()
    b = feeder_extract(pub, n=3, seed=7).collect()
    assert [tuple(map(repr, r)) for r in a] == [tuple(map(repr, r)) for r in b]  # seeded: repeatable (NaN-safe compare)
    feeders = {r.lv_feeder_unique_id for r in a}
    assert len(feeders) == 3
    keys = [(r.data_collection_log_timestamp, r.lv_feeder_unique_id) for r in a]
    assert keys == sorted(keys)  # timestamp then feeder
    assert set(a[0].asDict()) == {"data_collection_log_timestamp", "secondary_substation_unique_id", "lv_feeder_unique_id",
                                 "latitude", "longitude", "aggregated_device_count_active", "total_consumption_active_import"}


def test_rebuilding_published_month_replaces_its_files(spark, built):
    before = {r.file for r in R.published_files(spark, built["published"]).where("month = DATE'2024-01-01'").collect()}
    JB.build_combined_months(spark, built["staging"], built["published"], ["2024-02-01"])
    feb = R.read_published(spark, built["published"]).where("month = DATE'2024-02-01'")
    assert feb.count() == 812  # replaced, not appended
    assert {r.file for r in R.published_files(spark, built["published"]).where("month = DATE'2024-01-01'").collect()} == before  # other months untouched


def published_rows(spark, root, month):
    return sorted(map(repr, R.read_published(spark, root).where(F.col("month") == month).collect()))


def test_failed_rebuild_leaves_the_month(spark, built):
    """One task of a rebuild fails: the published month stays row for row."""
    from meterflow.sinks import geoparquet as GP

    GP.register(spark)
    root = built["published"]
    before = published_rows(spark, root, "2024-02-01")
    rows = R.read_published(spark, root).where("month = DATE'2024-02-01'").repartition(4)
    broken = rows.where(F.when(F.spark_partition_id() == 3, F.raise_error(F.lit("lost")).cast("boolean")).otherwise(True))
    with pytest.raises(Exception):
        broken.write.format("meterflow_geoparquet").mode("append").option("path", root).save()
    assert published_rows(spark, root, "2024-02-01") == before
    GP.sweep(root, age_s=0)
    named = {r.file.rsplit("/", 1)[0] for r in R.published_files(spark, root).collect()}
    kept = {os.path.relpath(os.path.dirname(f), f"{root}/files") for f in glob.glob(f"{root}/files/*/*/*")}
    assert kept == named and published_rows(spark, root, "2024-02-01") == before


def test_commit_that_breaks_off(spark, tmp_path, monkeypatch):
    """A driver lost at any point of the switch: each month is the old or the new one."""
    from meterflow.sinks import files as SINK
    from meterflow.sinks import geoparquet as GP

    staging, root = str(tmp_path / "st"), str(tmp_path / "pub")
    for m in (1, 2):
        nged_part_files(str(tmp_path / "raw"), 2024, m)
    months = ["2024-01-01", "2024-02-01"]
    JB.build_nged_months(spark, str(tmp_path / "raw"), staging, months)
    JB.build_combined_months(spark, staging, root, months)
    old = {m: published_rows(spark, root, m) for m in months}
    half = JB.combined_rows(spark, staging, months).where("lv_feeder_unique_id LIKE '%1'")
    new = None
    for calls in range(5):  # renames and new files: two of each
        steps = []

        def broken(fs, folder, lines, job, real=GP.switch_month):
            steps.append(folder)
            if len(steps) > calls // 2:
                if calls % 2:  # the file is there, under the name that readers skip
                    fs.create_dir(folder, recursive=True)
                    with fs.open_output_stream(f"{folder}/_000000000009-{job}.json") as out:
                        out.write(b"{half a line")
                raise RuntimeError("driver lost")
            real(fs, folder, lines, job)

        monkeypatch.setattr(GP, "switch_month", broken)
        try:
            SINK.write_published(half, root)
        except Exception as exc:
            assert "driver lost" in str(exc)
        monkeypatch.undo()
        now = {m: published_rows(spark, root, m) for m in months}
        new = new or {m: [r for r in old[m] if "1'" in r.split("lv_feeder_unique_id=")[1].split(",")[0]] for m in months}
        assert all(now[m] in (old[m], new[m]) for m in months)
        assert now == (old if calls < 2 else {months[0]: new[months[0]], months[1]: old[months[1]]} if calls < 4 else new)
    GP.sweep(root, age_s=0)
    assert {m: published_rows(spark, root, m) for m in months} == new


def test_a_box_skips_files(spark, built, tmp_path):
    """Files clustered by place: a small box reads some of them, and finds the same rows."""
    from meterflow.sinks import files as SINK

    rows = R.read_published(spark, built["published"]).drop("month")
    root = str(tmp_path / "space")
    SINK.write_published(rows, root, partitions=6, order="space")
    box = (-1.7, 51.3, -1.6, 51.4)  # SSEN 417 alone
    near = R.read_readings(spark, root, bbox=box)
    assert R.published_files(spark, root).count() >= 6 and len(near.inputFiles()) < R.published_files(spark, root).count()
    assert sorted(map(repr, near.drop("month").collect())) == sorted(map(repr, R.read_readings(spark, built["published"], bbox=box).drop("month").collect()))
    assert R.read_published(spark, root).count() == rows.count()
    assert R.read_readings(spark, root, bbox=(100.0, 10.0, 101.0, 11.0)).count() == 0
    listed = R.published_files(spark, root).agg(F.sum("n_rows"), F.min("x_min"), F.max("y_max"), F.min("ts_min")).first()
    both = rows.agg(F.count(F.lit(1)), F.min(F.nanvl("geometry.x", F.lit(None))), F.max(F.nanvl("geometry.y", F.lit(None))), F.min("data_collection_log_timestamp")).first()
    assert tuple(listed) == tuple(both)


def test_columns_are_taken_by_name_in_each_file(spark, tmp_path):
    """Files with swapped columns, a column more, or NGED spellings: the values of each name."""
    raw = str(tmp_path / "raw [1]")
    os.makedirs(raw)
    write_csv(f"{raw}/2024-02-01.csv.gz", S.SSEN_CSV_COLUMNS, ssen_rows("2024-02-01"))
    write_csv(f"{raw}/2024-02-02.csv.gz", S.SSEN_CSV_COLUMNS[::-1], ssen_rows("2024-02-02"))
    write_csv(f"{raw}/2024-02-03.csv.gz", ["new_one", *S.SSEN_CSV_COLUMNS], ssen_rows("2024-02-03"))
    open(f"{raw}/2024-02-04.csv", "w").close()  # nothing in it, not even a header
    got = R.read_daily_readings(spark, raw.replace("[", "\\[").replace("]", "\\]"), with_file=True)
    days = {}
    for r in got.collect():
        d = r.asDict()
        d.pop("source_file")
        day = d["data_collection_log_timestamp"].day
        days.setdefault(day, []).append({k: v for k, v in d.items() if k not in S.TIME_COLUMNS} | {"at": d["data_collection_log_timestamp"].time()})
    assert sorted(days) == [1, 2, 3] and all(sorted(map(repr, v)) == sorted(map(repr, days[1])) and len(v) == SSEN_PER_DAY for v in days.values())
    assert {r.source_file.rsplit("/", 1)[1] for r in got.select("source_file").distinct().collect()} == {f"2024-02-0{d}.csv.gz" for d in (1, 2, 3)}


def test_a_file_without_a_column_fails_by_name(spark, tmp_path):
    raw = str(tmp_path / "raw")
    os.makedirs(raw)
    write_csv(f"{raw}/2024-02-01.csv.gz", S.SSEN_CSV_COLUMNS, ssen_rows("2024-02-01"))
    write_csv(f"{raw}/2024-02-02.csv.gz", [c for c in S.SSEN_CSV_COLUMNS if c != "insert_time"], ssen_rows("2024-02-02"))
    with pytest.raises(ValueError, match="2024-02-02.*insert_time"):
        R.read_daily_readings(spark, raw)


def test_headers_need_the_first_lines_only(spark, tmp_path):
    from meterflow.sources import csvfiles as CSV

    big = tmp_path / "big.csv"
    big.write_text("a,b\n" + "1,2\n" * 400_000)
    (tmp_path / "two.csv").write_text('"b","a"\r\n3,4\r\n')
    assert [(f.rsplit("/", 1)[1], CSV.header_columns(line)) for f, line in CSV.file_headers(spark, str(tmp_path))] == [("big.csv", ["a", "b"]), ("two.csv", ["b", "a"])]
    rows = CSV.read_csv(spark, str(tmp_path)).groupBy("a", "b").count().collect()
    assert {tuple(r) for r in rows} == {("1", "2", 400_000), ("4", "3", 1)}


def test_month_rows_do_not_depend_on_the_batch(spark, tmp_path):
    """A row staged under another month than its own counts in neither build."""
    st = str(tmp_path / "st")
    nged_part_files(str(tmp_path / "raw"), 2024, 2)
    nged_part_files(str(tmp_path / "raw"), 2024, 3)
    JB.build_nged_months(spark, str(tmp_path / "raw"), st, ["2024-02-01", "2024-03-01"])
    stray = spark.read.parquet(st).where("month = DATE'2024-02-01'").limit(1)
    stray = stray.withColumn("data_collection_log_timestamp", F.lit("2024-03-01 00:00:00").cast(stray.schema["data_collection_log_timestamp"].dataType))
    stray.write.mode("append").partitionBy("dno", "month").parquet(st)
    n = {k: JB.combined_rows(spark, st, k.split()).count() for k in ("2024-02-01", "2024-03-01", "2024-02-01 2024-03-01")}
    assert n == {"2024-02-01": 232, "2024-03-01": 248, "2024-02-01 2024-03-01": 480}


def test_a_gap_in_the_parts_fails(spark, tmp_path):
    raw = str(tmp_path / "raw")
    files = nged_part_files(raw, 2024, 2, parts=4)
    os.rename(files[1], f"{tmp_path}/later.csv.gz")
    with pytest.raises(FileNotFoundError, match="part0001"):
        JB.build_nged_months(spark, raw, str(tmp_path / "st"), ["2024-02-01"])
    assert not os.path.exists(tmp_path / "st")
    assert JB.build_nged_months(spark, raw, str(tmp_path / "st"), ["2024-02-01"], allow_missing=True).stats.first().row_count == 29 * NGED_PER_DAY * 3 // 4


def test_rows_outside_go_with_their_month(spark, tmp_path):
    """A rebuilt month without stray rows reports none, though earlier ones lie aside."""
    raw, st = str(tmp_path / "raw"), str(tmp_path / "st")
    for extra, rows, outside in ((True, 249, [1]), (False, 248, [])):
        nged_part_files(raw, 2024, 1, extra_next_month=extra)
        built = JB.build_nged_months(spark, raw, st, ["2024-01-01"])
        assert built.stats.first().row_count == rows and [r.rows_outside_month for r in built.outside.collect()] == outside
        assert R.read_staging(spark, st).count() == 248


def test_listed_part_that_has_not_landed_fails(spark, tmp_path):
    files = nged_part_files(str(tmp_path / "raw"), 2024, 2)
    names = [os.path.basename(f) for f in files]
    with pytest.raises(FileNotFoundError, match="part0007"):
        JB.build_nged_months(spark, str(tmp_path / "raw"), str(tmp_path / "st"), ["2024-02-01"], listed=[*names, names[0].replace("part0000", "part0007")])


def test_pivot_over_the_feeders_present(spark):
    from meterflow.operators import aggregates as A

    df = spark.createDataFrame([(1, "1", 2.0), (1, "9", 3.0)], "t long, f string, v double")
    assert A.pivot_feeders(df, ["t"], "f", None, "v").first().asDict() == {"t": 1, "f_1": 2.0, "f_9": 3.0}
    with pytest.raises(Exception, match="outside the list"):
        A.pivot_feeders(df, ["t"], "f", ["1"], "v").collect()


def test_offset_bound_prunes_utc_months():
    import datetime as dt

    from meterflow.operators import filters as FL

    bound = dt.datetime(2024, 7, 1, tzinfo=dt.timezone(dt.timedelta(hours=1)))
    assert "2024-06-01" in str(FL.month_predicate_from_filters([("data_collection_log_timestamp", ">=", bound)]))
