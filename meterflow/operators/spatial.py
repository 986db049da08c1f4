"""Distance join of points to polygons (JN5), in projected metres.

Everything is an equi-join on a grid cell. Polygons are covered by a hierarchy
of cells: points in cells inside a polygon are settled by the join, and only
points in cells that an edge passes, or comes near to, meet edges, those of
their own cell. The work is proportional to (points x nearby edges), never to
(points x polygons x ring size), and a polygon's cells to its outline.
``point_polygon_distance`` keeps the whole-ring formula for single pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _edge_terms(ring: Column, px: Column, py: Column):
    n = F.size(ring)
    idx = F.sequence(F.lit(0), n - 1)

    def vert(i):
        return F.element_at(ring, i + 1)

    def nxt(i):
        return F.element_at(ring, ((i + 1) % n) + 1)

    def seg_dist2(acc, i):
        a, b = vert(i), nxt(i)
        ax, ay, bx, by = a["x"], a["y"], b["x"], b["y"]
        dx, dy = bx - ax, by - ay
        len2 = dx * dx + dy * dy
        t = F.when(len2 == 0, F.lit(0.0)).otherwise(((px - ax) * dx + (py - ay) * dy) / len2)
        t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
        qx, qy = ax + t * dx, ay + t * dy
        d2 = (px - qx) * (px - qx) + (py - qy) * (py - qy)
        return F.least(acc, d2)

    def crossing(acc, i):
        a, b = vert(i), nxt(i)
        ax, ay, bx, by = a["x"], a["y"], b["x"], b["y"]
        straddles = (ay > py) != (by > py)
        x_at = ax + (py - ay) * (bx - ax) / (by - ay)
        return acc + F.when(straddles & (px < x_at), F.lit(1)).otherwise(F.lit(0))

    min_d2 = F.aggregate(idx, F.lit(float("inf")), seg_dist2)
    crossings = F.aggregate(idx, F.lit(0), crossing)
    return min_d2, crossings


def point_polygon_distance(ring: Column, px: Column, py: Column) -> Column:
    """0 inside the ring (no closing vertex needed), else distance to the boundary."""
    min_d2, crossings = _edge_terms(ring, px, py)
    inside = (F.size(ring) >= 3) & ((crossings % 2) == 1)
    return F.when(inside, F.lit(0.0)).otherwise(F.sqrt(min_d2))


def polygon_edges(polygons: DataFrame, keys: list[str] | str = "polygon_id") -> DataFrame:
    """One row per ring edge (a 1-vertex ring gives one degenerate edge)."""
    keys = [keys] if isinstance(keys, str) else keys
    n = F.size("ring")
    idx = F.sequence(F.lit(0), n - 1)
    edges = F.transform(
        idx,
        lambda i: F.struct(
            F.element_at("ring", i + 1)["x"].alias("ax"),
            F.element_at("ring", i + 1)["y"].alias("ay"),
            F.element_at("ring", ((i + 1) % n) + 1)["x"].alias("bx"),
            F.element_at("ring", ((i + 1) % n) + 1)["y"].alias("by"),
        ),
    )
    return polygons.select(*keys, (n >= 3).alias("is_area"), F.explode(edges).alias("e")).select(
        *keys, "is_area", "e.ax", "e.ay", "e.bx", "e.by"
    )


# ---------------------------------------------------------------- polygon cover

#: a level's cells have FAN times the side of the level below
FAN = 4
#: the reference point of a cell, as a share of its side: off the middle, so
#: that edges along round coordinates don't run through it
REF_X, REF_Y = 0.5014142135, 0.5017320508
#: rounding allowed for when a line is clipped to a cell, as a share of its side
SLACK = 1e-7


def _side(level: Column, side: float) -> Column:
    return F.lit(float(side)) * F.pow(F.lit(float(FAN)), level)


def _cells_along(edges: DataFrame, side: Column, grow: float = 0.0) -> DataFrame:
    """``edges`` with a row per cell (cx, cy) within ``grow`` of the edge: column
    by column, the rows between which the edge passes it. The rows follow the
    length of an edge, not the area of its box."""
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    left, right = F.least(ax, bx), F.greatest(ax, bx)
    cols = edges.withColumn("__side", side).withColumn("cx", F.explode(F.sequence(F.floor((left - grow) / F.col("__side")), F.floor((right + grow) / F.col("__side")))))
    s = F.col("__side")
    slack = s * SLACK + grow

    def y_at(x):  # the edge's y, x clipped to the edge
        x = F.least(F.greatest(x, left), right)
        return F.when(ax == bx, ay).otherwise(ay + F.try_divide((x - ax) * (by - ay), bx - ax))

    y0, y1 = y_at(F.col("cx") * s - slack), y_at((F.col("cx") + 1) * s + slack)
    upright = ax == bx
    low = F.when(upright, F.least(ay, by)).otherwise(F.least(y0, y1))
    high = F.when(upright, F.greatest(ay, by)).otherwise(F.greatest(y0, y1))
    rows = F.sequence(F.floor((low - slack) / s), F.floor((high + slack) / s))
    return cols.withColumn("cy", F.explode(rows)).drop("__side")


def _levels(ring: Column, side: float) -> Column:
    """The top level of a ring: a cell there is wider than it, so none lies inside."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    extent = F.greatest(F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys))
    return F.when(F.size(ring) < 3, 0).otherwise(F.ceil(F.log(F.greatest(extent / side, F.lit(1.0))) / math.log(FAN) + 1e-9).cast("int") + 1)


def polygon_cover(polygons: DataFrame, side: float, polygon_key: str = "polygon_id") -> DataFrame:
    """Cells that tell where the inside of each polygon is: polygon_key, level,
    cx, cy, inside.

    Level 0 has the cells of side ``side`` that edges pass, with whether their
    reference point is inside. All other cells lie inside as a whole: the largest
    ones of a hierarchy (sides ``side * FAN ** level``) that no edge passes.
    A polygon that is as wide as n cells of level 0 gets a number of cells in
    proportion to its outline in such cells, not to its area.

    One aggregate finds the cells: a cell that edges pass proposes its FAN x FAN
    parts on the level below, and those no edge passes remain. They and the
    passed cells of level 0 are told apart by scan lines: the edges' crossings
    with the line through the reference points of a row of cells, counted from
    the right by a window per polygon, level and row.
    """
    shaped = polygons.where(F.size("ring") >= 3).select(polygon_key, "ring", F.explode(F.sequence(F.lit(0), _levels(F.col("ring"), side))).alias("level"))
    edges = polygon_edges(shaped, [polygon_key, "level"]).drop("is_area")
    s = _side(F.col("level"), side)

    passed = _cells_along(edges, s).select(polygon_key, "level", "cx", "cy")
    steps = F.sequence(F.lit(0), F.lit(FAN - 1))
    parts = F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct(
        (F.col("level") - 1).alias("level"), (F.col("cx") * FAN + i).alias("cx"), (F.col("cy") * FAN + j).alias("cy"), F.lit(False).alias("passed"))
    )))
    itself = F.array(F.struct(F.col("level"), F.col("cx"), F.col("cy"), F.lit(True).alias("passed")))
    proposed = passed.select(polygon_key, F.explode(F.when(F.col("level") > 0, F.concat(itself, parts)).otherwise(itself)).alias("c"))
    cells = (
        proposed.groupBy(polygon_key, "c.level", "c.cx", "c.cy").agg(F.max("c.passed").alias("passed"))
        .where(~F.col("passed") | (F.col("level") == 0))
    )

    ay, by = F.col("ay"), F.col("by")
    line = (F.col("cy") + REF_Y) * s
    crossings = (
        edges.where(ay != by)
        .withColumn("cy", F.explode(F.sequence(F.floor(F.least(ay, by) / s - REF_Y), F.ceil(F.greatest(ay, by) / s - REF_Y))))
        .where((ay > line) != (by > line))
        .select(polygon_key, "level", "cy", (F.col("ax") + F.try_divide((line - ay) * (F.col("bx") - F.col("ax")), by - ay)).alias("x"), F.lit(None).cast("long").alias("cx"), F.lit(None).cast("boolean").alias("passed"))
    )
    asked = cells.select(polygon_key, "level", "cy", ((F.col("cx") + REF_X) * s).alias("x"), "cx", "passed")
    # from the right; a crossing counts for the points left of it
    row = Window.partitionBy(polygon_key, "level", "cy").orderBy(F.desc("x"), F.col("cx").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = asked.unionByName(crossings).withColumn("inside", F.count(F.when(F.col("cx").isNull(), 1)).over(row) % 2 == 1)
    return told.where(F.col("cx").isNotNull() & (F.col("inside") | F.col("passed"))).select(polygon_key, "level", "cx", "cy", "passed", "inside")


def within_distance_pairs(
    points: DataFrame,
    polygons: DataFrame,
    distance: float,
    point_key: str = "point_id",
    polygon_key: str = "polygon_id",
    cell: float | None = None,
    strict: bool = False,
) -> DataFrame:
    """(point, polygon, distance) for every pair closer than ``distance``.

    ``points``: point_key, x, y (metres). ``polygons``: polygon_key, ring
    array<struct<x,y>> in metres without the closing vertex (a 1- or
    2-vertex ring is a point or a segment). ``strict`` uses < for the cut.

    Two equi-joins on cells, no ring evaluated whole per candidate. With the
    cells of ``polygon_cover`` (smallest side ``cell``): a point in a cell that
    lies inside is settled by the join. With the edges, by the cells of level 0
    within ``distance`` of them: the least distance to these is the true one
    within the cut, and in a cell that edges pass, the way from the point to the
    cell's reference point (first along its row, then along the reference's
    column) crosses only edges of this cell; an odd number of crossings means
    that the two lie on different sides.
    """
    s = float(cell or max(distance, 1.0))
    pts = points.select(point_key, "x", "y")
    px, py = F.col("x"), F.col("y")

    cover = polygon_cover(polygons, s, polygon_key)
    highest = polygons.agg(F.max(_levels(F.col("ring"), s)))
    levels = F.explode(F.sequence(F.lit(0), F.coalesce(highest.scalar(), F.lit(0)))).alias("level")
    at = pts.select(point_key, "x", "y", levels)
    side = _side(F.col("level"), s)
    at = at.select(point_key, "level", F.floor(px / side).alias("cx"), F.floor(py / side).alias("cy"))
    inside = at.join(cover, ["level", "cx", "cy"]).select(
        point_key, polygon_key, F.lit(None).cast("double").alias("d2"), F.lit(0).alias("crossed"),
        (F.col("inside") & ~F.col("passed")).alias("whole"), F.when(F.col("passed"), F.col("inside")).alias("reference"),
    )

    edges = _cells_along(polygon_edges(polygons, [polygon_key]), F.lit(s), distance)
    pc = pts.select(point_key, "x", "y", F.floor(px / s).alias("cx"), F.floor(py / s).alias("cy"))
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    rx, ry = (F.col("cx") + REF_X) * s, (F.col("cy") + REF_Y) * s
    # an edge along the way has no crossing, and a null place
    x_at = ax + F.try_divide((py - ay) * (bx - ax), by - ay)
    y_at = ay + F.try_divide((rx - ax) * (by - ay), bx - ax)
    along = ((ay > py) != (by > py)) & ((px < x_at) != (rx < x_at))
    across = ((ax > rx) != (bx > rx)) & ((py < y_at) != (ry < y_at))
    met = pc.join(edges, ["cx", "cy"]).select(
        point_key, polygon_key, _segment_distance2(px, py, ax, ay, bx, by).alias("d2"),
        (F.when(along, 1).otherwise(0) + F.when(across, 1).otherwise(0)).alias("crossed"),
        F.lit(False).alias("whole"), F.lit(None).cast("boolean").alias("reference"),
    )

    both = inside.unionByName(met).groupBy(point_key, polygon_key).agg(
        F.sqrt(F.min("d2")).alias("near_m"), (F.sum("crossed") % 2 == 1).alias("__odd"), F.max("whole").alias("__whole"), F.max("reference").alias("__ref")
    )
    is_inside = F.col("__whole") | F.coalesce(F.col("__ref") != F.col("__odd"), F.lit(False))
    out = both.select(point_key, polygon_key, F.when(is_inside, F.lit(0.0)).otherwise(F.col("near_m")).alias("distance_m"))
    return out.where((F.col("distance_m") < distance) if strict else (F.col("distance_m") <= distance))


def within_distance(
    points: DataFrame, polygons: DataFrame, distance: float, point_key: str = "point_id", **kw
) -> DataFrame:
    """Points within ``distance`` of any polygon: a left-semi result (JN5)."""
    pairs = within_distance_pairs(points, polygons, distance, point_key=point_key, **kw)
    return points.join(pairs.select(point_key).distinct(), point_key, "left_semi")


def _segment_distance2(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    len2 = dx * dx + dy * dy
    t = F.when(len2 == 0, F.lit(0.0)).otherwise(((px - ax) * dx + (py - ay) * dy) / len2)
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    qx, qy = ax + t * dx, ay + t * dy
    return (px - qx) * (px - qx) + (py - qy) * (py - qy)


def areas_within_distance(
    areas: DataFrame, polygons: DataFrame, distance: float, area_key: str, polygon_key: str = "polygon_id", cell: float | None = None
) -> DataFrame:
    """Distinct ``area_key`` of the areas (points, lines, polygons) that come
    within ``distance`` of a polygon anywhere (``dwithin`` of two geometries).

    Both have a ``ring`` in metres. They are near if two of their edges cross or
    are near (edges meet in a common grid cell only), or if one lies inside the
    other: without such edges it does so whole, so one vertex tells.
    """
    s = float(cell or max(distance, 1.0))
    a = _cells_along(polygon_edges(areas, area_key), F.lit(s))
    b = _cells_along(polygon_edges(polygons, polygon_key), F.lit(s), distance).select(
        "cx", "cy", *[F.col(c).alias(f"p_{c}") for c in ("ax", "ay", "bx", "by")]
    )
    ax, ay, bx, by, cx, cy, dx, dy = (F.col(c) for c in ("ax", "ay", "bx", "by", "p_ax", "p_ay", "p_bx", "p_by"))

    def turn(px, py, qx, qy, rx, ry):
        return F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))

    across = (turn(ax, ay, bx, by, cx, cy) * turn(ax, ay, bx, by, dx, dy) < 0) & (turn(cx, cy, dx, dy, ax, ay) * turn(cx, cy, dx, dy, bx, by) < 0)
    d2 = F.least(
        _segment_distance2(ax, ay, cx, cy, dx, dy), _segment_distance2(bx, by, cx, cy, dx, dy),
        _segment_distance2(cx, cy, ax, ay, bx, by), _segment_distance2(dx, dy, ax, ay, bx, by),
    )
    edges = a.join(b, ["cx", "cy"]).where(across | (F.sqrt(d2) <= distance)).select(area_key)

    def vertex(df, key):
        return df.select(key, F.col("ring")[0]["x"].alias("x"), F.col("ring")[0]["y"].alias("y"))

    inside = within_distance_pairs(vertex(areas, area_key), polygons, distance, area_key, polygon_key, s).select(area_key)
    around = within_distance_pairs(vertex(polygons, polygon_key), areas, distance, polygon_key, area_key, s).select(area_key)
    return edges.unionByName(inside).unionByName(around).distinct()
