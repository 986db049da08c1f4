"""Readers and sinks not covered by the job tests (SC3-SC5, SC11, SC12, SK3-SK5)."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from meterflow.sinks import files as SINK
from meterflow.sources import manifests as M
from meterflow.sources import readers as R


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_postcode_directory_picks_file_and_nulls_sentinels(spark, workdir):
    write(f"{workdir}/onspd/Data/ONSPD_FEB_2024_UK.csv", "pcd,lat,long,oa11\nAB1 0AA,57.101474,-2.242851,x\nAB1 0AN,99.999999,0.000000,y\nAB1 0AB,99.999999,-2.1,z\nAB1 0AC,57.2,0.000000,w\n")
    write(f"{workdir}/onspd/Documents/readme.csv", "pcd,lat,long\nZZ9 9ZZ,1,1\n")
    df = R.read_postcode_directory(spark, f"{workdir}/onspd", ["pcd", "lat", "long"])
    got = {r.pcd: (r.lat, r.long) for r in df.collect()}
    assert got == {"AB1 0AA": (57.101474, -2.242851), "AB1 0AN": (None, None), "AB1 0AB": (None, -2.1), "AB1 0AC": (57.2, None)}


def test_mapping_keeps_leading_zeros(spark, workdir):
    write(f"{workdir}/map.csv", "dataset_id,postcode,primary_substation_id,hv_feeder_id,secondary_substation_id,lv_feeder_id\n000200200402,DD2 4RU,0002,002,004,02\n")
    r = R.read_postcode_mapping(spark, f"{workdir}/map.csv").first()
    assert (r.dataset_id, r.primary_substation_id, r.lv_feeder_id) == ("000200200402", "0002", "02")


def test_transformer_model(spark, workdir):
    write(f"{workdir}/model.csv", "full_nrn,latitude,longitude,other\n0001_001_001,57.1,-2.2,a\n1_1_1,,-2.3,b\n")
    rows = R.read_transformer_model(spark, f"{workdir}/model.csv", ["full_nrn", "latitude", "longitude"]).orderBy(F.col("file_row.row")).collect()
    assert [(r.full_nrn, r.latitude, r.longitude) for r in rows] == [("0001_001_001", 57.1, -2.2), ("1_1_1", None, -2.3)]


def test_file_order_survives_many_splits(spark, workdir):
    """Rows in the order of the file, though splits of a few KB are read in any order (WN2 strict)."""
    from meterflow.operators import windows as W

    lines = [f"{i % 400:04d}_001_001,{50 + i / 100000},{-1 - i / 100000}" for i in range(20_000)]
    write(f"{workdir}/model.csv", "full_nrn,latitude,longitude\n" + "\n".join(lines) + "\n")
    small = {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        model = R.read_transformer_model(spark, f"{workdir}/model.csv", ["full_nrn", "latitude", "longitude"])
        assert model.rdd.getNumPartitions() > 20
        rows = model.orderBy("file_row").collect()
        assert [r.latitude for r in rows] == [50 + i / 100000 for i in range(20_000)]
        first = {r.full_nrn: r.latitude for r in W.dedupe_model(model, strict=True).collect()}
        assert first == {f"{i:04d}_001_001": 50 + i / 100000 for i in range(400)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_npg_listing_and_resource_lookup(spark, workdir):
    npg = {"attachments": [{"href": "https://x/lv-feeder-1.csv", "metas": {"id": "lv-feeder-data", "title": "t"}},
                           {"href": "https://x/other.pdf", "metas": {"id": "report", "title": "r"}}]}
    write(f"{workdir}/npg.json", json.dumps(npg))
    assert [r.url for r in M.file_manifest_npg(spark, f"{workdir}/npg.json").collect()] == ["https://x/lv-feeder-1.csv"]
    pkg = {"result": {"resources": [{"id": "abc", "last_modified": "2024-11-02T10:11:12"}, {"id": "def", "last_modified": "2024-01-01T00:00:00"}]}}
    write(f"{workdir}/pkg.json", json.dumps(pkg))
    r = M.resource_last_modified(spark, f"{workdir}/pkg.json", "abc").first()
    assert str(r.last_modified) == "2024-11-02 10:11:12"
    with pytest.raises(Exception, match="not found"):
        M.resource_last_modified(spark, f"{workdir}/pkg.json", "zzz").collect()


def test_lookup_and_csv_extract_sinks(spark, workdir):
    lk = spark.createDataFrame([("0002002004", "51.79,-2.53", 1)], "substation_nrn string, substation_geo_location string, extra int")
    SINK.write_location_lookup(lk, f"{workdir}/lookup")
    assert R.read_location_lookup(spark, f"{workdir}/lookup").columns == ["substation_nrn", "substation_geo_location"]
    SINK.write_csv_extract(lk, f"{workdir}/extract", ["substation_geo_location", "substation_nrn"])
    header = open(glob.glob(f"{workdir}/extract/*.csv")[0]).readline().strip()
    assert header == "substation_geo_location,substation_nrn"


def test_clear_month(spark, workdir):
    from meterflow import schemas as S

    df = spark.createDataFrame([], S.STAGING_SCHEMA)
    row = spark.createDataFrame(
        [("a", "SSEN", "1", "n", "1", "f", "1,1", 1.0, 2.0, None, None, None)], S.STAGING_SCHEMA
    ).withColumn("data_collection_log_timestamp", F.lit("2024-02-03 00:30:00").cast("timestamp"))
    SINK.write_staging(row.unionByName(df), f"{workdir}/st", "SSEN")
    assert spark.read.parquet(f"{workdir}/st").count() == 1
    SINK.clear_month(spark, f"{workdir}/st", "2024-02-01", "SSEN")
    assert spark.read.parquet(f"{workdir}/st/dno=SSEN/month=2024-02-01").count() == 0


def test_scratch_of_an_application_goes(spark):
    from meterflow import session

    kept = session.scratch_table(spark.range(3), "gone")
    assert kept.count() == 3
    session.remove_scratch(spark)
    session.remove_scratch(spark)  # nothing there: nothing to do
    assert not glob.glob(kept.inputFiles()[0].replace("file://", "")) if kept.inputFiles() else True
