"""Convex hulls of point groups and their measures (GE3-GE8, FI9, AG3, AG13).

Plan for ``convex_hulls``:

1. A plain aggregate (JVM, combined map-side) finds each group's farthest points
   in ``DIRECTIONS`` directions, and a join on the group drops the points that lie
   strictly inside the polygon of these: they are on no hull. Of a dense group a
   few per cent are left.
2. ``mapInPandas`` over what is left, the only place where Python sees points:
   groups with more than a few points in an Arrow batch become their hull there,
   before any shuffle. The partial hulls are written once to the shared folder.
3. Partial hulls are merged in a tree, ``FAN_IN`` tasks' parts at a time, as deep as
   the number of tasks that made them needs; a node holds at most that many
   partial hulls, however hot the group (an Arrow ``pandas_udf`` running the
   monotone chain).

The hull is taken in degrees, as the data's lon/lat, then measured in
British National Grid metres with Column math (no Python).
"""

from __future__ import annotations

import math
import sys
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import geo as G
from ..session import scratch_table

# Python workers get this module's functions by value, so executors need no
# copy of the package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

# groups up to this many points pass the map side untouched
_PARTIAL_MIN_POINTS = 8


def _orient(o, a, b) -> int:
    """Sign of the cross product (a - o) x (b - o), exact near zero."""
    ax, ay = a[0] - o[0], a[1] - o[1]
    bx, by = b[0] - o[0], b[1] - o[1]
    det = ax * by - ay * bx
    err = 1e-12 * (abs(ax * by) + abs(ay * bx))
    if det > err:
        return 1
    if det < -err:
        return -1
    fo = [Fraction(v) for v in o]
    fa = [Fraction(v) for v in a]
    fb = [Fraction(v) for v in b]
    exact = (fa[0] - fo[0]) * (fb[1] - fo[1]) - (fa[1] - fo[1]) * (fb[0] - fo[0])
    return (exact > 0) - (exact < 0)


def hull_vertices(xs: np.ndarray, ys: np.ndarray) -> list[tuple[float, float]]:
    """Monotone chain; collinear and repeated points are dropped.

    Returns 1 vertex (point), 2 (segment ends) or a counter-clockwise ring
    without the closing vertex.
    """
    pts = sorted(set(zip(map(float, xs), map(float, ys))))
    if len(pts) <= 2:
        return pts
    lower: list = []
    for p in pts:
        while len(lower) >= 2 and _orient(lower[-2], lower[-1], p) <= 0:
            lower.pop()
        lower.append(p)
    upper: list = []
    for p in reversed(pts):
        while len(upper) >= 2 and _orient(upper[-2], upper[-1], p) <= 0:
            upper.pop()
        upper.append(p)
    ring = lower[:-1] + upper[:-1]
    if len(ring) == 2 or len(ring) < 2:
        return ring if ring else pts[:1]
    return ring


_HULL_TYPE = T.StructType(
    [
        T.StructField("xs", T.ArrayType(T.DoubleType())),
        T.StructField("ys", T.ArrayType(T.DoubleType())),
        T.StructField("mxs", T.ArrayType(T.DoubleType())),
        T.StructField("mys", T.ArrayType(T.DoubleType())),
    ]
)


@F.pandas_udf(_HULL_TYPE)
def _hull_udf(xs: pd.Series, ys: pd.Series, mxs: pd.Series, mys: pd.Series) -> pd.DataFrame:
    out_x, out_y, out_mx, out_my = [], [], [], []
    for gx, gy, gmx, gmy in zip(xs, ys, mxs, mys):
        metres = {}
        for k in range(len(gx)):
            metres.setdefault((float(gx[k]), float(gy[k])), (float(gmx[k]), float(gmy[k])))
        ring = hull_vertices(np.asarray(gx, dtype=float), np.asarray(gy, dtype=float))
        out_x.append([p[0] for p in ring])
        out_y.append([p[1] for p in ring])
        out_mx.append([metres[p][0] for p in ring])
        out_my.append([metres[p][1] for p in ring])
    return pd.DataFrame({"xs": out_x, "ys": out_y, "mxs": out_mx, "mys": out_my})


def _partial_hulls(group: str):
    def reduce_batches(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            sizes = pdf.groupby(group, sort=False, dropna=False)["x"].transform("size")
            small = pdf[sizes <= _PARTIAL_MIN_POINTS]
            big = pdf[sizes > _PARTIAL_MIN_POINTS]
            if not small.empty:
                yield small
            if not big.empty:
                rows = []
                for key, g in big.groupby(group, sort=False, dropna=False):
                    key = None if pd.isna(key) else key
                    g = g.drop_duplicates(["x", "y"])
                    metres = dict(zip(zip(g["x"], g["y"]), zip(g["mx"], g["my"])))
                    for vx, vy in hull_vertices(g["x"].to_numpy(), g["y"].to_numpy()):
                        mx, my = metres[(vx, vy)]
                        rows.append((key, vx, vy, mx, my))
                yield pd.DataFrame(rows, columns=[group, "x", "y", "mx", "my"]).astype(pdf.dtypes.to_dict())

    return reduce_batches


DIRECTIONS = 16
FAN_IN = 64
#: a point this close to an edge of the polygon, against the terms of its cross product, stays
MARGIN = 1e-9


def farthest_points(points: DataFrame, group: str) -> DataFrame:
    """Per group the farthest points in ``DIRECTIONS`` directions, counter-clockwise:
    __x0, __y0, __x1, ... The two ``max_by`` of a direction see the same order, so
    they pick one point."""
    aggs = []
    for k in range(DIRECTIONS):
        turn = 2 * math.pi * k / DIRECTIONS
        along = F.col("x") * math.cos(turn) + F.col("y") * math.sin(turn)
        aggs += [F.max_by("x", along).alias(f"__x{k}"), F.max_by("y", along).alias(f"__y{k}")]
    return points.groupBy(F.col(group).alias("__group")).agg(*aggs)


def outer_points(points: DataFrame, group: str) -> DataFrame:
    """``points`` without those strictly inside the polygon of their group's
    farthest points. Points near its edges stay, as do all points of a group
    whose farthest points span no area."""
    far = farthest_points(points, group)
    joined = points.join(far, points[group].eqNullSafe(far["__group"]))
    inside, edges = F.lit(True), F.lit(0)
    for k in range(DIRECTIONS):
        n = (k + 1) % DIRECTIONS
        ax, ay = F.col(f"__x{k}"), F.col(f"__y{k}")
        dx, dy = F.col(f"__x{n}") - ax, F.col(f"__y{n}") - ay
        left, right = dx * (F.col("y") - ay), dy * (F.col("x") - ax)
        none = (dx == 0) & (dy == 0)
        inside = inside & (none | (left - right > (F.abs(left) + F.abs(right)) * MARGIN))
        edges = edges + F.when(none, 0).otherwise(1)
    return joined.where(~(inside & (edges >= 3))).select(*points.columns)


def _hull_step(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hull the points of each ``keys`` group."""
    g = df.groupBy(*keys).agg(F.collect_set(F.struct("x", "y", "mx", "my")).alias("__pts"))
    return g.select(*keys, _hull_udf(F.col("__pts.x"), F.col("__pts.y"), F.col("__pts.mx"), F.col("__pts.my")).alias("__h"))


def _vertices(hulls: DataFrame, keys: list[str]) -> DataFrame:
    h = F.col("__h")
    return hulls.select(*keys, F.explode(F.arrays_zip(h["xs"].alias("x"), h["ys"].alias("y"), h["mxs"].alias("mx"), h["mys"].alias("my"))).alias("v")).select(
        *keys, "v.x", "v.y", "v.mx", "v.my"
    )


def convex_hulls(points: DataFrame, group: str, x: str = "x", y: str = "y", project: bool = True) -> DataFrame:
    """Hull per group (GE3, AG13): (group, hull, hull_m, geometry_type).

    ``hull`` is array<struct<x,y>> in the input coordinates (degrees for
    lon/lat), taken there as the data defines it; ``hull_m`` holds the same
    vertices in BNG metres. The points are projected before the hull step
    (plain per-row Column math, of the outer points alone), so the vertex metres
    come out of the UDF as a column: later filters on measures cannot be inlined
    back into the projection. With ``project=False`` the input is already planar.
    Rows with a null coordinate are ignored.
    """
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    pts = points.select(group, xc.alias("x"), yc.alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    pts = outer_points(pts, group)
    if project:
        m = G.project_bng(F.col("x"), F.col("y"))
        pts = pts.select(group, "x", "y", m["x"].alias("mx"), m["y"].alias("my"))
    else:
        pts = pts.select(group, "x", "y", F.col("x").alias("mx"), F.col("y").alias("my"))
    made = pts.mapInPandas(_partial_hulls(group), pts.schema).withColumn("__part", F.spark_partition_id())
    partial = scratch_table(made, "partial-hulls")
    parts = (partial.agg(F.max("__part")).first()[0] or 0) + 1
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        step = partial.withColumn("__part", F.floor(F.col("__part") / FAN_IN).cast("int"))
        partial = _vertices(_hull_step(step, [group, "__part"]), [group, "__part"])
    hulled = _hull_step(partial.drop("__part"), [group])
    hull = F.arrays_zip(F.col("__h.xs").alias("x"), F.col("__h.ys").alias("y"))
    hull_m = F.arrays_zip(F.col("__h.mxs").alias("x"), F.col("__h.mys").alias("y"))
    return hulled.select(group, hull.alias("hull"), hull_m.alias("hull_m")).withColumn("geometry_type", geometry_type("hull"))


def geometry_type(hull: Column | str) -> Column:
    """Point / LineString / Polygon from the vertex count (GE5)."""
    n = F.size(F.col(hull) if isinstance(hull, str) else hull)
    return F.when(n == 1, F.lit("Point")).when(n == 2, F.lit("LineString")).otherwise(F.lit("Polygon"))


def project_hull(hull: Column | str) -> Column:
    """Every vertex lon/lat -> BNG metres (GE2 on arrays)."""
    h = F.col(hull) if isinstance(hull, str) else hull
    return F.transform(h, lambda p: G.project_bng(p["x"], p["y"]))


def hull_measures(hulls: DataFrame, hull: str = "hull") -> DataFrame:
    """Adds length_m (line length / polygon perimeter), area_m2, coordinate
    count (closing vertex included), the centroid in metres (centroid_m)
    and in degrees (centroid) (GE4-GE8)."""
    kind = F.col("geometry_type")
    n = F.size(F.col(hull))
    metres = f"{hull}_m"
    with_proj = hulls.withColumn("__m", F.col(metres) if metres in hulls.columns else project_hull(hull))
    m = F.col("__m")
    length = F.when(kind == "Point", F.lit(0.0)).when(kind == "LineString", G.path_length(m, False)).otherwise(
        G.path_length(m, True)
    )
    area = F.when(kind == "Polygon", G.ring_area(m)).otherwise(F.lit(0.0))
    count = F.when(kind == "Polygon", n + 1).otherwise(n)
    mid = F.struct(((m[0]["x"] + m[1]["x"]) / 2).alias("x"), ((m[0]["y"] + m[1]["y"]) / 2).alias("y"))
    centroid_m = F.when(kind == "Point", m[0]).when(kind == "LineString", mid).otherwise(G.ring_centroid(m))
    out = with_proj.withColumns(
        {
            "length_m": length,
            "area_m2": area,
            "coordinate_count": count,
            "__c": centroid_m,
        }
    )
    # a single point is its own centroid: no projection round trip
    centroid = F.when(kind == "Point", F.col(hull)[0]).otherwise(G.unproject_point(F.col("__c")))
    return out.withColumn("centroid", centroid).withColumnRenamed("__c", "centroid_m").drop("__m")


def plausible_predicate(strict_lines: bool = False) -> Column:
    """Point; line <= 100 m; polygon <= 10,000 m2 and mean edge <= 100 m (FI9)."""
    kind = F.col("geometry_type")
    mean_edge = F.col("length_m") / F.col("coordinate_count")
    line_ok = (F.col("length_m") < S.MAX_LINE_LENGTH_M) if strict_lines else (F.col("length_m") <= S.MAX_LINE_LENGTH_M)
    return (
        (kind == "Point")
        | ((kind == "LineString") & line_ok)
        | ((kind == "Polygon") & (F.col("area_m2") <= S.MAX_POLYGON_AREA_M2) & (mean_edge <= S.MAX_POLYGON_MEAN_EDGE_M))
    )


def plausible_areas(measured: DataFrame) -> DataFrame:
    """Keep the hulls small enough for a centroid to stand for them (FI9)."""
    return measured.where(plausible_predicate())


def area_quality_stats(measured: DataFrame) -> DataFrame:
    """Counts by type; excluded lines; excluded polygons both as the reference
    counts them (area AND mean edge) and as FI9 drops them (area OR mean) (AG3)."""
    kind = F.col("geometry_type")
    mean_edge = F.col("length_m") / F.col("coordinate_count")
    big_area = F.col("area_m2") > S.MAX_POLYGON_AREA_M2
    long_edges = mean_edge > S.MAX_POLYGON_MEAN_EDGE_M
    return measured.agg(
        F.count(F.lit(1)).alias("nunique_substations"),
        F.count_if(kind == "Point").alias("single_point_locations"),
        F.count_if(kind == "LineString").alias("line_locations"),
        F.count_if(kind == "Polygon").alias("polygon_locations"),
        F.count_if((kind == "LineString") & (F.col("length_m") > S.MAX_LINE_LENGTH_M)).alias("excluded_lines"),
        F.count_if((kind == "Polygon") & big_area & long_edges).alias("excluded_polygons"),
        F.count_if((kind == "Polygon") & (big_area | long_edges)).alias("excluded_polygons_actual"),
    )
