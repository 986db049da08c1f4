"""JN5 by the polygon cover: against plain distances, and the size of a cover."""

import math
import random

import pytest
from pyspark.sql import functions as F

from meterflow.operators import spatial as SP

RING = "array<struct<x: double, y: double>>"


def plain(p, ring):
    inside, best = False, math.inf
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > p[1]) != (by > p[1]) and p[0] < ax + (p[1] - ay) * (bx - ax) / (by - ay):
            inside = not inside
        dx, dy = bx - ax, by - ay
        t = max(0.0, min(1.0, ((p[0] - ax) * dx + (p[1] - ay) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        best = min(best, math.hypot(p[0] - ax - t * dx, p[1] - ay - t * dy))
    return 0.0 if inside and len(ring) >= 3 else best


def star(rnd, x, y, r, n):
    return [(x + r * rnd.uniform(0.2, 1) * math.cos(2 * math.pi * i / n), y + r * rnd.uniform(0.2, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]


def comb(x, y, teeth, w, h):
    """Long thin teeth: deep bays between them."""
    top = [p for i in range(teeth) for p in ((x + 2 * i * w, y + h), (x + (2 * i + 1) * w, y + h), (x + (2 * i + 1) * w, y + w), (x + (2 * i + 2) * w, y + w))]
    return [(x, y), *top, (x + 2 * teeth * w, y)]


@pytest.mark.parametrize("cell,distance", [(400.0, 250.0), (3000.0, 250.0), (100.0, 0.0)])
def test_against_plain_distances(spark, cell, distance):
    rnd = random.Random(5)
    polys = {i: star(rnd, rnd.uniform(0, 20_000), rnd.uniform(0, 20_000), rnd.uniform(50, 9000), rnd.choice([3, 5, 12, 60])) for i in range(8)}
    polys[20] = comb(2000.0, 3000.0, 15, 200.0, 6000.0)
    polys[21] = [(0.0, 0.0), (16_000.0, 0.0), (16_000.0, 16_000.0), (0.0, 16_000.0)]  # along the cells
    polys[22] = [(5000.0, 5000.0), (5000.0, 5000.0), (9000.0, 5000.0), (9000.0, 9000.0)]  # a repeated vertex
    polys[23], polys[24] = [(100.0, 100.0)], [(100.0, 9000.0), (12_000.0, 9500.0)]
    pts = [(i, rnd.uniform(-3000, 23_000), rnd.uniform(-3000, 23_000)) for i in range(700)]
    pts += [(1000 + i, float(200 * i), float(200 * (i * 7 % 90))) for i in range(90)]  # on round coordinates
    points = spark.createDataFrame(pts, "point_id long, x double, y double")
    areas = spark.createDataFrame(list(polys.items()), f"polygon_id long, ring {RING}")
    got = {(r.point_id, r.polygon_id): r.distance_m for r in SP.within_distance_pairs(points, areas, distance, cell=cell).collect()}
    want = {(i, k): d for i, x, y in pts for k, ring in polys.items() if (d := plain((x, y), ring)) <= distance}
    # a point upon an edge is at distance 0 with or without the inside
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)
    assert 100 < len(want) < len(pts) * len(polys)


def test_cover_is_exact_and_follows_the_outline(spark):
    counts = {}
    for n in (100_000.0, 500_000.0):
        ring = [(0.0, 0.0), (n, 0.1 * n), (0.8 * n, n), (0.4 * n, 0.5 * n)]
        area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2
        cover = SP.polygon_cover(spark.createDataFrame([(1, ring)], f"polygon_id long, ring {RING}"), 1000.0)
        row = cover.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.when(~F.col("passed"), F.pow(F.lit(16.0), "level") * 1e6)).alias("inside"), F.count_if("passed").alias("passed")
        ).first()
        assert area - 1.5e6 * row.passed < row.inside < area  # whole cells inside, none outside
        counts[n] = row.n
    assert counts[500_000.0] < 6 * counts[100_000.0] < 6 * 8 * 400  # 5 times the outline, 25 times the area


def test_long_oblique_edge_makes_a_strip_of_cells(spark):
    edge = spark.createDataFrame([(0.0, 0.0, 100_000.0, 90_000.0)], "ax double, ay double, bx double, by double")
    assert SP._cells_along(edge, F.lit(100.0), 50.0).count() < 6 * 2000


def test_no_join_on_rows_of_cells_alone(spark):
    pts = spark.createDataFrame([(1, 0.0, 0.0)], "point_id long, x double, y double")
    areas = spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])], f"polygon_id long, ring {RING}")
    plan = SP.within_distance_pairs(pts, areas, 10.0)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 2 and all("cx" in j and "cy" in j for j in joins)


def test_empty_sides(spark):
    pts = spark.createDataFrame([(1, 0.0, 0.0)], "point_id long, x double, y double")
    areas = spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])], f"polygon_id long, ring {RING}")
    assert SP.within_distance_pairs(pts, areas.limit(0), 10.0).count() == 0
    assert SP.within_distance_pairs(pts.limit(0), areas, 10.0).count() == 0
