"""Hulls of dense and hot groups: few points reach Python, partial hulls merge in a tree."""

import math
import random

import numpy as np
import pytest

from meterflow.operators import hull as H


def cloud(rnd, n, kind):
    if kind == "disc":
        out = []
        while len(out) < n:
            x, y = rnd.uniform(-1, 1), rnd.uniform(-1, 1)
            if x * x + y * y <= 1:
                out.append((x, y))
        return out
    if kind == "lattice":
        return [(rnd.randrange(9) / 8, rnd.randrange(9) / 8) for _ in range(n)]
    if kind == "line":
        return [(t := rnd.random(), 2 * t + 1) for _ in range(n)]
    if kind == "circle":
        return [(math.cos(2 * math.pi * i / n), math.sin(2 * math.pi * i / n)) for i in range(n)]
    return [(0.25, 0.5)] * n


SHAPES = {"a": ("disc", 5000), "b": ("lattice", 400), "c": ("line", 60), "d": ("circle", 300), "e": ("point", 20), "f": ("disc", 3), "g": ("disc", 1), None: ("disc", 40)}


def frame(spark):
    rnd = random.Random(6)
    points = {k: cloud(rnd, n, kind) for k, (kind, n) in SHAPES.items()}
    rows = [(k, x, y) for k, v in points.items() for x, y in v] + [("a", None, 1.0), ("z", None, None)]
    rnd.shuffle(rows)
    return points, spark.createDataFrame(rows, "g string, x double, y double")


@pytest.mark.parametrize("parts,fan", [(3, 64), (40, 4)])
def test_hulls_are_those_of_all_points(spark, monkeypatch, parts, fan):
    monkeypatch.setattr(H, "FAN_IN", fan)  # 40 tasks, merged by fours: a tree of three levels
    points, df = frame(spark)
    got = {r.g: [(p.x, p.y) for p in r.hull] for r in H.convex_hulls(df.repartition(parts), "g", project=False).collect()}
    want = {k: H.hull_vertices(*np.asarray(v).T) for k, v in points.items()}
    assert got == want


def test_few_points_of_a_dense_group_are_left(spark):
    points, df = frame(spark)
    left = {r.g: r["count"] for r in H.outer_points(df.dropna(subset=["x", "y"]), "g").groupBy("g").count().collect()}
    assert left["a"] < 0.05 * len(points["a"])
    assert left["c"] == 60 and left["d"] == 300 and left["e"] == 20 and left["f"] == 3 and left["g"] == 1  # nothing to drop
