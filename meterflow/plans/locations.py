"""Substation location jobs (GE12, GE13, GE14, JB9)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import filters as FI
from ..operators import hull as H
from ..operators import joins as J
from ..operators import spatial as SP
from ..operators import windows as W
from ..operators.gridshift import GridSpec, grid_shift
from ..session import scratch_table


def postcode_points(mapping: DataFrame, directory: DataFrame, distinct: bool = False) -> DataFrame:
    """Located feeder postcodes: (standardised_postcode, substation_nrn, lat, long).

    PR7 + FI1 on the mapping, PR9 for the reference number, PR7 + dropna on
    the directory, JN3 left join, FI2 drop unmatched. ``distinct``: each place
    once, for what depends on the set of places alone; repetitions go on either
    side before the join, which would give a row for each pair of them.
    """
    m = mapping.withColumn("standardised_postcode", C.standardise_postcode("postcode"))
    m = FI.valid_postcodes(m).select(
        "standardised_postcode",
        C.nrn_from_parts("primary_substation_id", "hv_feeder_id", "secondary_substation_id").alias("substation_nrn"),
    )
    d = directory.select(C.standardise_postcode("pcd").alias("standardised_postcode"), "lat", "long").dropna()
    if distinct:
        return FI.located(J.locate_postcodes(m.distinct(), d.distinct()))
    return FI.located(J.locate_postcodes(m, d))


def measured_hulls(points: DataFrame, key: str = "substation_nrn", lon: str = "long", lat: str = "lat") -> DataFrame:
    pts = points.select(key, F.col(lon).alias("x"), F.col(lat).alias("y"))
    return H.hull_measures(H.convex_hulls(pts, key))


def substation_locations_from_postcodes(mapping: DataFrame, directory: DataFrame) -> DataFrame:
    """Lookup A: centroid of each substation's postcode hull, when plausible (GE12)."""
    measured = measured_hulls(postcode_points(mapping, directory, distinct=True))
    ok = H.plausible_areas(measured)
    return ok.select(
        "substation_nrn",
        C.format_location(F.col("centroid")["y"], F.col("centroid")["x"]).alias("substation_geo_location"),
    )


# -- GE9 without a grid: seven-parameter Helmert, OSGB36 -> WGS84 ------------------
# Published OSGB36 <-> WGS84 parameters (metres, ppm, arc-seconds),
# here in the OSGB36 -> WGS84 direction.
HELMERT_TX, HELMERT_TY, HELMERT_TZ = 446.448, -125.157, 542.060
HELMERT_S_PPM = -20.4894
HELMERT_RX_SEC, HELMERT_RY_SEC, HELMERT_RZ_SEC = 0.1502, 0.2470, 0.8421
GRS80_A, GRS80_B = 6_378_137.0, 6_356_752.3141


def helmert_osgb36_to_wgs84(lon: Column, lat: Column) -> Column:
    """Approximate datum shift as Column math (metre-level; the grid is exact)."""
    e2a = 1 - (S.AIRY_B / S.AIRY_A) ** 2
    phi, lam = F.radians(lat), F.radians(lon)
    nu = F.lit(S.AIRY_A) / F.sqrt(1 - F.lit(e2a) * F.sin(phi) ** 2)
    x = nu * F.cos(phi) * F.cos(lam)
    y = nu * F.cos(phi) * F.sin(lam)
    z = nu * (1 - e2a) * F.sin(phi)
    s = HELMERT_S_PPM * 1e-6
    rx, ry, rz = (math.radians(v / 3600.0) for v in (HELMERT_RX_SEC, HELMERT_RY_SEC, HELMERT_RZ_SEC))
    x2 = HELMERT_TX + (1 + s) * x - rz * y + ry * z
    y2 = HELMERT_TY + rz * x + (1 + s) * y - rx * z
    z2 = HELMERT_TZ - ry * x + rx * y + (1 + s) * z
    e2b = 1 - (GRS80_B / GRS80_A) ** 2
    p = F.sqrt(x2 * x2 + y2 * y2)
    phi2 = F.atan2(z2, p * (1 - e2b))
    for _ in range(5):
        nu2 = F.lit(GRS80_A) / F.sqrt(1 - F.lit(e2b) * F.sin(phi2) ** 2)
        phi2 = F.atan2(z2 + F.lit(e2b) * nu2 * F.sin(phi2), p)
    return F.struct(F.degrees(F.atan2(y2, x2)).alias("x"), F.degrees(phi2).alias("y"))


def substation_locations_from_model(
    model: DataFrame,
    grid: DataFrame | None = None,
    spec: GridSpec | None = None,
    strict: bool = False,
) -> DataFrame:
    """Lookup B from the transformer load model (GE13): WN2, FI2, PR8, GE9, PR12.

    With a shift grid the coordinates are repaired exactly (method 'grid');
    without one a Helmert approximation is used and flagged ('helmert').
    The reference numbers are de-duplicated again after formatting (EX2),
    so '1_1_1' and '0001_001_001' cannot both reach the readings join.
    """
    first = W.dedupe_model(model, strict=strict)
    located = FI.located(first, "latitude", "longitude").withColumn("substation_nrn", C.nrn_from_full("full_nrn"))
    if grid is not None:
        if spec is None:
            raise ValueError("grid needs its GridSpec")
        fixed = grid_shift(located, grid, spec).withColumn("method", F.lit("grid"))
    else:
        pt = helmert_osgb36_to_wgs84(F.col("longitude"), F.col("latitude"))
        fixed = located.withColumns({"latitude": pt["y"], "longitude": pt["x"], "method": F.lit("helmert")})
    out = fixed.select(
        "substation_nrn",
        C.format_location("latitude", "longitude").alias("substation_geo_location"),
        "method",
        "file_row",
    )
    return W.first_by(out, ["substation_nrn"], ["file_row"]).drop("file_row")


def license_area_locations(
    mapping: DataFrame, directory: DataFrame, areas: DataFrame, distance_m: float = 1000.0, cell_m: float | None = None
) -> DataFrame:
    """Postcode-derived substation areas within ``distance_m`` of a licence
    area polygon (GE14, ADR form: strict thresholds, no area bound).

    ``areas``: polygon_id, ring array<struct<x=lon, y=lat>>.
    """
    measured = measured_hulls(postcode_points(mapping, directory, distinct=True))
    kind = F.col("geometry_type")
    keep = (kind == "Point") | ((kind == "LineString") & (F.col("length_m") < S.MAX_LINE_LENGTH_M)) | (
        (kind == "Polygon") & (F.col("length_m") / F.col("coordinate_count") < S.MAX_POLYGON_MEAN_EDGE_M)
    )
    # both are read several times below
    subs = scratch_table(measured.where(keep), "substation-areas")
    polys = scratch_table(areas.select("polygon_id", H.project_hull("ring").alias("ring")), "licence-areas")
    shapes = subs.select("substation_nrn", F.col("hull_m").alias("ring"))
    near = SP.areas_within_distance(shapes, polys, distance_m, "substation_nrn", cell=cell_m)
    return subs.join(near, "substation_nrn", "left_semi")


def location_coverage(all_nrns: DataFrame, lookup_a: DataFrame, lookup_b: DataFrame) -> DataFrame:
    """How many substations each lookup locates, alone and together (JB9: JN4, JN6)."""
    a = lookup_a.where(F.col("substation_geo_location").isNotNull())
    b = lookup_b.where(F.col("substation_geo_location").isNotNull())
    return J.coverage_summary(J.coverage_sets(all_nrns, a, b))
