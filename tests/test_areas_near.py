"""GE14: whole substation areas against licence areas, not their centroids."""

import math
import random

from meterflow.operators import spatial as SP
from meterflow.plans import locations as L

RING = "array<struct<x: double, y: double>>"


def test_an_area_that_reaches_in_stays_with_its_centroid_far(spark):
    lat, lon, n = 52.0, -1.5, 110
    north, east = 1 / 111_250, 1 / 68_680  # degrees a metre
    codes = [f"AB{10 + i % 90} {1 + i // 90}AA" for i in range(2 * n)]
    mapping, directory = [], []
    for c, (nrn, off) in zip(codes, [("1", 0.0)] * n + [("2", 1500.0)] * n):  # the second lies 1.5 km further out
        i = len(mapping) % n
        mapping.append((c, nrn, "1", "1"))
        directory.append((c, lat + 1400 * north * math.sin(2 * math.pi * i / n), lon + (off + 1400 * math.cos(2 * math.pi * i / n)) * east))
    edge = lon - 2000 * east
    ring = [(edge - 0.5, lat - 0.5), (edge, lat - 0.5), (edge, lat + 0.5), (edge - 0.5, lat + 0.5)]
    out = L.license_area_locations(
        spark.createDataFrame(mapping, "postcode string, primary_substation_id string, hv_feeder_id string, secondary_substation_id string"),
        spark.createDataFrame(directory, "pcd string, lat double, long double"),
        spark.createDataFrame([(1, ring)], f"polygon_id long, ring {RING}"),
    )
    assert [r.substation_nrn[:4] for r in out.collect()] == ["0001"]  # 600 m away; its centroid is 2 km away


def test_near_areas_against_plain_distances(spark):
    rnd = random.Random(4)

    def shape(at, size):
        x, y, k, r = rnd.uniform(0, at), rnd.uniform(0, at), rnd.choice([1, 2, 3, 6]), rnd.uniform(5, size)
        turns = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(k))
        return [(x + r * math.cos(t), y + r * math.sin(t)) for t in turns]

    areas = {i: shape(20_000, 800) for i in range(150)}
    polys = {i: shape(20_000, 4000) for i in range(6)}
    areas[200] = [(-90_000.0, -90_000.0), (90_000.0, -90_000.0), (0.0, 120_000.0)]  # around all of them
    areas[201] = [(-50_000.0, 9_990.0), (70_000.0, 10_010.0)]

    def edges(ring):
        return [(ring[i], ring[(i + 1) % len(ring)]) for i in range(len(ring))]

    def to_edge(p, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)

    def turn(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    def holds(ring, p):
        return len(ring) > 2 and sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in edges(ring)) % 2 == 1

    def close(r, s, d):
        if any(holds(r, p) for p in s) or any(holds(s, p) for p in r):
            return True
        for a, b in edges(r):
            for p, q in edges(s):
                if turn(a, b, p) * turn(a, b, q) < 0 and turn(p, q, a) * turn(p, q, b) < 0:
                    return True
                if min(to_edge(a, p, q), to_edge(b, p, q), to_edge(p, a, b), to_edge(q, a, b)) <= d:
                    return True
        return False

    frame = lambda shapes, key: spark.createDataFrame(list(shapes.items()), f"{key} long, ring {RING}")
    for cell in (1000.0, 7000.0):
        got = {r.area for r in SP.areas_within_distance(frame(areas, "area"), frame(polys, "polygon_id"), 500.0, "area", cell=cell).collect()}
        want = {k for k, r in areas.items() if any(close(r, s, 500.0) for s in polys.values())}
        assert got == want and 0 < len(want) < len(areas)
