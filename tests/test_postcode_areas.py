"""Postcode areas depend on the set of places, not on how often rows repeat."""

from meterflow.operators import joins as J
from meterflow.plans import locations as L


def test_repeated_rows_go_before_the_join(spark, monkeypatch):
    places = [("AB1 0AA", 57.10, -2.24), ("AB1 0AB", 57.1001, -2.2401), ("AB1 0AC", 57.1002, -2.2399)]
    directory = spark.createDataFrame(places * 50, "pcd string, lat double, long double")
    mapping = spark.createDataFrame([(p, "1", "2", "3") for p, _, _ in places] * 40, "postcode string, primary_substation_id string, hv_feeder_id string, secondary_substation_id string")
    seen, join = [], J.locate_postcodes

    def watched(m, d, *more):
        seen.append((m.count(), d.count()))
        return join(m, d, *more)

    monkeypatch.setattr(J, "locate_postcodes", watched)
    many = L.substation_locations_from_postcodes(mapping, directory).collect()
    assert seen == [(3, 3)]
    once = L.substation_locations_from_postcodes(mapping.distinct(), directory.distinct()).collect()
    assert many == once and len(many) == 1
    assert L.postcode_points(mapping, directory).count() == 3 * 50 * 40  # JN3 itself keeps every pair
