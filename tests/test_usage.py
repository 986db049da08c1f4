"""The README's usage example, run end to end on generated files."""

import os

from fixtures import nged_part_files, ssen_daily_files

from meterflow.operators import joins as J
from meterflow.plans import analytics, jobs, locations
from meterflow.sources import readers as R
from meterflow.streaming.ingest import ingest_stream


def test_readme_pipeline(spark, tmp_path):
    base = str(tmp_path)
    ssen_daily_files(f"{base}/raw/ssen", 2024, 2)
    ssen_daily_files(f"{base}/raw/ssen", 2024, 3, days=[1, 2])
    nged_part_files(f"{base}/raw/nged", 2024, 2)
    nged_part_files(f"{base}/raw/nged", 2024, 3, parts=2)
    os.makedirs(f"{base}/raw/ons/onspd/Data")
    open(f"{base}/raw/ons/onspd/Data/ONSPD_X.csv", "w").write("pcd,lat,long\nRG9 1XA,51.534218,-0.902113\nRG9 1XB,51.534218,-0.902153\n")
    open(f"{base}/raw/ssen/lv_feeder_postcode_mapping.csv", "w").write(
        "dataset_id,postcode,primary_substation_id,hv_feeder_id,secondary_substation_id,lv_feeder_id,lv_feeder_name\n"
        "531002441703,RG9 1XA,5310,024,417,03,\n531002441711,RG9 1XB,5310,024,417,11,\n"
    )
    open(f"{base}/raw/ssen/transformers.csv", "w").write("full_nrn,latitude,longitude\n5310_24_862,51.603001,-0.954002\n")

    lookup_a = locations.substation_locations_from_postcodes(
        R.read_postcode_mapping(spark, f"{base}/raw/ssen/lv_feeder_postcode_mapping.csv"),
        R.read_postcode_directory(spark, f"{base}/raw/ons/onspd", ["pcd", "lat", "long"]),
    )
    lookup_b = locations.substation_locations_from_model(
        R.read_transformer_model(spark, f"{base}/raw/ssen/transformers.csv", ["full_nrn", "latitude", "longitude"]), grid=None
    )
    lookup = J.merged_location_lookup(lookup_a, lookup_b.select("substation_nrn", "substation_geo_location"))
    got = dict(map(tuple, lookup.collect()))
    assert got["5310024417"] == "51.534218,-0.902133"  # line midpoint of the two postcodes
    lat, lon = map(float, got["5310024862"].split(","))  # Helmert fallback: about a hundred metres off
    assert 0 < abs(lat - 51.603001) < 0.01 and 0 < abs(lon + 0.954002) < 0.01

    months = ["2024-02-01", "2024-03-01"]
    staging, published = f"{base}/staging", f"{base}/published"
    jobs.build_ssen_months(spark, f"{base}/raw/ssen", lookup, staging, months)
    jobs.build_nged_months(spark, f"{base}/raw/nged", staging, months)
    jobs.build_combined_months(spark, staging, published, months)
    seen = []
    # only the day files are readings; the folder also holds the reference CSVs
    ingest_stream(spark, f"{base}/raw/ssen", lambda ms: seen.append(ms), checkpoint=f"{base}/ckpt/ingest", glob="20*.csv*")
    assert seen == [months]

    counts = {str(r.month): r["count"] for r in R.read_published(spark, published).groupBy("month").count().collect()}
    assert counts == {"2024-02-01": 812, "2024-03-01": 40 + 248}
    half_hour = R.read_readings(
        spark, published, filters=[("data_collection_log_timestamp", "=", "2024-03-01 04:30:00")], bbox=(-3.0, 50.0, 0.0, 58.0)
    )
    assert analytics.consumption_map(half_hour).count() == 4
    daily = analytics.feeder_timeseries(
        R.read_readings(spark, published, filters=[("secondary_substation_unique_id", "==", "SSEN-5310024417")])
    )
    assert daily.count() == 2 * 31  # two feeders, 1 Feb .. 2 Mar
