"""Geometry: projection, hulls, measures, plausibility, centroids, grid
shift and the distance join (GE1-GE14, FI9, JN5)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from meterflow.functions import geo as G
from meterflow.operators import hull as H
from meterflow.operators import spatial as SP
from meterflow.operators.gridshift import GridSpec, grid_shift
from meterflow.plans import locations as L

MAP_SCHEMA = "primary_substation_id string, hv_feeder_id string, secondary_substation_id string, postcode string"
DIR_SCHEMA = "pcd string, lat double, long double"


def test_projection_matches_worked_example(spark):
    lat = 52 + 39 / 60 + 27.2531 / 3600
    lon = 1 + 43 / 60 + 4.5177 / 3600
    r = spark.range(1).select(G.project_bng(F.lit(lon), F.lit(lat)).alias("p")).first().p
    assert r.x == pytest.approx(651409.903, abs=1e-3)
    assert r.y == pytest.approx(313177.270, abs=1e-3)


def test_projection_round_trip(spark):
    rnd = random.Random(7)
    pts = [(rnd.uniform(-8, 2), rnd.uniform(49.9, 60.9)) for _ in range(200)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    back = df.select("lon", "lat", G.unproject_point(G.project_bng("lon", "lat")).alias("q")).collect()
    for r in back:
        assert abs(r.q.x - r.lon) < 1e-9 and abs(r.q.y - r.lat) < 1e-9


CORNER = (51.534001, -0.902003)  # of the made-up sites below


def site(name: str, *offsets: tuple[float, float]) -> tuple[list, list]:
    """Postcodes of one substation at the corner plus (north, east) degrees."""
    codes = [f"RG{i + 1} {len(name)}X{chr(65 + i)}" for i in range(len(offsets))]
    mapping = [("5310", "024", name, c) for c in codes]
    return mapping, [(c, CORNER[0] + n, CORNER[1] + e) for c, (n, e) in zip(codes, offsets)]


def located(spark, *sites, extra_mapping=()):
    mapping = [m for s in sites for m in s[0]] + list(extra_mapping)
    directory = [d for s in sites for d in s[1]]
    out = L.substation_locations_from_postcodes(spark.createDataFrame(mapping, MAP_SCHEMA), spark.createDataFrame(directory, DIR_SCHEMA))
    return {r.substation_nrn: tuple(map(float, r.substation_geo_location.split(","))) for r in out.collect()}


def metres(a, b):
    """Great-circle distance, worked without the projection under test."""
    (p, q), (r, t) = (map(math.radians, x) for x in (a, b))
    h = math.sin((r - p) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((t - q) / 2) ** 2
    return 2 * 6_371_000 * math.asin(math.sqrt(h))


TRIANGLE = site("417", (0, 0), (0.0006, 0), (0, 0.0009))


def test_hull_centre_by_number_of_points(spark):
    """A point is itself, a segment its middle, a triangle the mean of its corners."""
    for offsets in ([(0.0, 0.0)], [(0, 0), (0.0002, 0.0006)], [(0, 0), (0.0006, 0), (0, 0.0009)]):
        got = located(spark, site("417", *offsets))["5310024417"]
        want = [CORNER[i] + sum(o[i] for o in offsets) / len(offsets) for i in (0, 1)]
        assert got == pytest.approx(tuple(want), abs=1.1e-6)


def test_postcodes_that_locate_nothing(spark):
    """Too short, null, and absent from the directory; spacing and case do not matter."""
    odd = [("5310", "024", "871", "RG1"), ("5310", "024", "872", None), ("5310", "024", "873", "ZZ9 9ZZ"), ("5310", "024", "874", "rg1   3xa")]
    got = located(spark, TRIANGLE, extra_mapping=odd)
    assert set(got) == {"5310024417", "5310024874"}
    assert got["5310024874"] == pytest.approx(CORNER, abs=1e-6)


@pytest.mark.parametrize(
    "offsets",
    [
        [(0, 0), (0.0030, 0)],  # a line of 330 m
        [(0, 0), (0.0027, 0), (0, 0.0043), (0.0027, 0.0043)],  # a field of 300 m by 300 m
        [(0, 0), (0, 0.0072), (0.000001, 0), (0.000001, 0.0072)],  # a sliver of 500 m
    ],
)
def test_implausible_areas_are_left_out(spark, offsets):
    got = located(spark, TRIANGLE, site("8620", *offsets))
    assert set(got) == {"5310024417"}


def test_measures_against_great_circles(spark):
    n, e = 0.0027, 0.0043
    corners = {"line": [(0, 0), (0, e)], "field": [(0, 0), (n, 0), (0, e), (n, e)]}
    pts = [(g, CORNER[0] + a, CORNER[1] + b) for g, offsets in corners.items() for a, b in offsets]
    m = {r.g: r for r in H.hull_measures(H.convex_hulls(spark.createDataFrame(pts, "g string, y double, x double"), "g")).collect()}
    east = metres(CORNER, (CORNER[0], CORNER[1] + e))
    north = metres(CORNER, (CORNER[0] + n, CORNER[1]))
    assert m["line"].geometry_type == "LineString" and m["line"].length_m == pytest.approx(east, rel=5e-3)
    assert m["field"].area_m2 == pytest.approx(east * north, rel=1e-2)
    assert m["field"].length_m == pytest.approx(2 * (east + north), rel=5e-3)


def test_hull_reduces_hot_group_map_side(spark):
    # one group with many points spread over partitions: same hull as a tiny group
    rnd = random.Random(3)
    pts = [("hot", rnd.uniform(0, 1), rnd.uniform(0, 1)) for _ in range(5000)]
    pts += [("hot", 0.0, 0.0), ("hot", 1.0, 0.0), ("hot", 1.0, 1.0), ("hot", 0.0, 1.0)]
    df = spark.createDataFrame(pts, "g string, x double, y double").repartition(8)
    h = H.convex_hulls(df, "g").first()
    assert sorted((p.x, p.y) for p in h.hull) == [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)]


def test_helmert_fallback_moves_north_west_to_the_national_datum(spark):
    """Without a grid the seven-parameter shift applies: between the datums lie
    some 100 m in England, and the row says which method was used."""
    model = spark.createDataFrame([("53_7_862", 51.603001, -0.954002, 0)], "full_nrn string, latitude double, longitude double, file_row long")
    r = L.substation_locations_from_model(model).first()
    lat, lon = (float(v) for v in r.substation_geo_location.split(","))
    assert r.method == "helmert" and r.substation_nrn == "0053007862"
    assert 30 < metres((51.603001, -0.954002), (lat, lon)) < 200


def test_grid_shift_bilinear(spark):
    spec = GridSpec(lat0=57.0, lon0=-3.0, dlat=0.5, dlon=0.5)
    grid = spark.createDataFrame(
        [(0, 0, 0.0, 0.0), (1, 0, 1.0, 0.0), (0, 1, 0.0, 2.0), (1, 1, 1.0, 2.0)], "i long, j long, shift_lat double, shift_lon double"
    )
    pts = spark.createDataFrame([(1, 57.25, -2.75), (2, 60.0, -2.75)], "id long, latitude double, longitude double")
    got = {r.id: (r.latitude, r.longitude) for r in grid_shift(pts, grid, spec).collect()}
    assert got[1] == pytest.approx((57.25 + 0.5, -2.75 + 1.0))
    assert got[2] == (None, None)  # outside the grid


def test_within_distance_matches_brute_force(spark):
    rnd = random.Random(11)
    polys = []
    for pid in range(6):
        cx, cy = rnd.uniform(0, 20000), rnd.uniform(0, 20000)
        ring = [(cx + 1500 * math.cos(a), cy + 900 * math.sin(a)) for a in [k * 2 * math.pi / 7 for k in range(7)]]
        polys.append((pid, ring))
    pts = [(i, rnd.uniform(-2000, 22000), rnd.uniform(-2000, 22000)) for i in range(800)]
    pdf = spark.createDataFrame([(pid, [{"x": x, "y": y} for x, y in ring]) for pid, ring in polys], "polygon_id long, ring array<struct<x:double,y:double>>")
    ptdf = spark.createDataFrame(pts, "point_id long, x double, y double")
    got = {(r.point_id, r.polygon_id) for r in SP.within_distance_pairs(ptdf, pdf, 500.0, cell=1000.0).collect()}

    def dist(px, py, ring):
        inside = False
        n = len(ring)
        best = float("inf")
        for k in range(n):
            (ax, ay), (bx, by) = ring[k], ring[(k + 1) % n]
            if (ay > py) != (by > py) and px < ax + (py - ay) * (bx - ax) / (by - ay):
                inside = not inside
            dx, dy = bx - ax, by - ay
            t = max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))
            best = min(best, math.hypot(px - ax - t * dx, py - ay - t * dy))
        return 0.0 if inside else best

    want = {(i, pid) for i, x, y in pts for pid, ring in polys if dist(x, y, ring) <= 500.0}
    assert got == want and len(want) > 0
