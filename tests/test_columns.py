"""Column rules: ids, postcodes, locations, rounding, blanks (PR*, N*)."""

import pytest
from pyspark.sql import functions as F

from meterflow.functions import columns as C
from meterflow.operators import transform as T


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_zfill_never_truncates(spark):
    got = one(spark, C.zfill("v", 3), [("1",), ("0001",), ("12",), (None,)], "v string")
    assert got == ["001", "0001", "012", None]


def test_nrn_from_parts_strips_integer_zeros(spark):
    # '0001' next to '001' must give the same padded part (digits read as numbers)
    rows = [("0001", "0001", "001"), ("1", "1", "1"), ("0001", "001", "001")]
    got = one(spark, C.nrn_from_parts("p", "h", "s"), rows, "p string, h string, s string")
    assert got == ["0001001001"] * 3


def test_nrn_from_full(spark):
    got = one(spark, C.nrn_from_full("f"), [("1_1_1",), ("0001_001_001",), ("12_345_6",)], "f string")
    assert got == ["0001001001", "0001001001", "0012345006"]


def test_nrn_from_full_rejects_bad_shape(spark):
    with pytest.raises(Exception, match="not three parts"):
        one(spark, C.nrn_from_full("f"), [("1_1",)], "f string")


def test_standardise_postcode(spark):
    got = one(spark, C.standardise_postcode("p"), [("ab1  0aa",), (" AB1 0AA ",), ("AB1\t0AA",), (None,)], "p string")
    assert got == ["AB10AA", "AB10AA", "AB10AA", None]


def test_parse_location_nged_style(spark):
    got = one(spark, C.parse_location("l"), [("54.020406, -.715203",), ("50.61,-3.07",), (None,)], "l string")
    assert got[0].x == pytest.approx(-0.715203) and got[0].y == pytest.approx(54.020406)
    assert (got[1].x, got[1].y) == (-3.07, 50.61)
    assert got[2] is None


def test_round_half_even(spark):
    got = one(spark, C.round_half_even_long("v"), [(876.5,), (877.5,), (-0.5,), (None,), (float("nan"),)], "v double")
    assert got == [876, 878, 0, None, None]


def test_unique_ids_null_propagates(spark):
    df = spark.createDataFrame(
        [("NGED", None, "918273", "6"), ("SSEN", "771004506103", "061", "03"), ("NGED", None, None, "6")],
        "dno_alias string, dataset_id string, secondary_substation_id string, lv_feeder_id string",
    )
    rows = T.unique_ids(df).select("secondary_substation_unique_id", "lv_feeder_unique_id").collect()
    assert tuple(rows[0]) == ("NGED-918273", "NGED-918273-6")
    assert tuple(rows[1]) == ("SSEN-7710045061", "SSEN-771004506103")
    assert tuple(rows[2]) == (None, None)


def test_unique_ids_unknown_dno_is_error(spark):
    df = spark.createDataFrame([("UKPN", "x", "1", "1")], "dno_alias string, dataset_id string, secondary_substation_id string, lv_feeder_id string")
    with pytest.raises(Exception, match="no rule for the ids"):
        T.unique_ids(df).collect()


def test_blank_tokens_become_null(spark):
    vals = ["", " ", ",", " ,", ", ", " , ", "x"]
    got = one(spark, C.blank_to_null("v"), [(v,) for v in vals], "v string")
    assert got == [None] * 6 + ["x"]


def test_month_from_urls(spark):
    df = spark.createDataFrame(
        [("https://h/x/2024-02-12.csv", "https://h/y/aggregated-smart-meter-data-lv-feeder-2024-01-part0000.csv")], "s string, n string"
    )
    r = df.select(C.month_from_url("s", "SSEN").alias("a"), C.month_from_url("n", "NGED").alias("b")).first()
    assert (str(r.a), str(r.b)) == ("2024-02-01", "2024-01-01")


def test_count_distinct_with_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    assert df.agg(C.count_distinct_with_null("v")).first()[0] == 3
    assert df.agg(F.count_distinct("v")).first()[0] == 2
