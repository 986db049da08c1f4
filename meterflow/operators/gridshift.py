"""Horizontal grid shift (GE9).

Coordinates that were converted from British National Grid to degrees
without the national shift grid are repaired by reading them as OSGB36
lon/lat and adding the grid's (dlat, dlon), bilinearly interpolated from the
four surrounding nodes. The grid is a table (i, j, shift_lat, shift_lon in
degrees), so the lookup is an equi-join on node index: each point becomes
four (i, j, weight) rows, joined to the grid and summed back per point.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GridSpec:
    """Node (i, j) sits at (lat0 + i * dlat, lon0 + j * dlon), degrees."""

    lat0: float
    lon0: float
    dlat: float
    dlon: float


def grid_from_ntv2_seconds(df: DataFrame) -> DataFrame:
    """Grid rows with shifts in arc-seconds (NTv2 style) -> degrees."""
    return df.select(
        "i", "j", (F.col("shift_lat_sec") / 3600.0).alias("shift_lat"), (F.col("shift_lon_sec") / 3600.0).alias("shift_lon")
    )


def grid_cells(grid: DataFrame) -> DataFrame:
    """A row per grid cell (by its lowest node) with the shifts of its four nodes;
    a node that the grid lacks is null."""
    places = [(0, 0), (1, 0), (0, 1), (1, 1)]
    at = F.array(*[F.struct((F.col("i") - di).cast("long").alias("i"), (F.col("j") - dj).cast("long").alias("j"), F.lit(k).alias("k")) for k, (di, dj) in enumerate(places)])
    nodes = grid.select(F.explode(at).alias("c"), "shift_lat", "shift_lon").select("c.*", "shift_lat", "shift_lon")
    aggs = [F.max(F.when(F.col("k") == k, F.col(f"shift_{x}"))).alias(f"__{x}{k}") for x in ("lat", "lon") for k in range(4)]
    return nodes.groupBy(F.col("i").alias("__i"), F.col("j").alias("__j")).agg(*aggs)


def grid_shift(points: DataFrame, grid: DataFrame, spec: GridSpec, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """``points`` with ``lat`` and ``lon`` shifted by the interpolated grid value.

    Each point meets the one row of its grid cell; its other columns go along.
    A point with a missing node (outside the grid) gets null coordinates rather
    than a partial shift.
    """
    fi = (F.col(lat) - F.lit(spec.lat0)) / F.lit(spec.dlat)
    fj = (F.col(lon) - F.lit(spec.lon0)) / F.lit(spec.dlon)
    at = points.withColumns({"__i": F.floor(fi), "__j": F.floor(fj), "__ti": fi - F.floor(fi), "__tj": fj - F.floor(fj)})
    ti, tj = F.col("__ti"), F.col("__tj")
    weights = [(1 - ti) * (1 - tj), ti * (1 - tj), (1 - ti) * tj, ti * tj]

    def moved(x: str, start: Column) -> Column:
        # a node without weight may be missing
        parts = [F.when(w > 0, w * F.col(f"__{x}{k}")).otherwise(F.lit(0.0)) for k, w in enumerate(weights)]
        return start + (parts[0] + parts[1] + parts[2] + parts[3])

    joined = at.join(grid_cells(grid), ["__i", "__j"], "left")
    new = {lat: moved("lat", F.col(lat)), lon: moved("lon", F.col(lon))}
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in points.columns])
