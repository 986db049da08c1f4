"""Queries for substation locations: postcodes, reference numbers, hulls,
projection, grid shift, distance join and lookup coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import geo as G
from ..operators import aggregates as A
from ..operators import filters as FI
from ..operators import hull as H
from ..operators import joins as J
from ..operators import spatial as SP
from ..operators import windows as W
from ..operators.gridshift import GridSpec, grid_shift
from ..plans import locations as L
from ..session import scratch_table
from ..sources import readers as R
from ..sources import testdata as TD
from . import sqlgeo
from .registry import register

# ---------------------------------------------------------------------------
# Spark views
# ---------------------------------------------------------------------------


def mapping(spark: SparkSession, sf: str) -> DataFrame:
    return TD.view(spark, sf, "mapping")


def directory(spark: SparkSession, sf: str) -> DataFrame:
    return R.postcode_directory_from_text(TD.view(spark, sf, "directory"), ["pcd", "lat", "long"])


def model(spark: SparkSession, sf: str) -> DataFrame:
    return R.model_from_text(TD.view(spark, sf, "model"))


# the synthetic shift grid: 40 x 40 nodes, 0.05 degrees apart, from 56.5 N 3.5 W
GRID_SPEC = GridSpec(lat0=56.5, lon0=-3.5, dlat=0.05, dlon=0.05)
GRID_N = 40


def shift_grid(spark: SparkSession) -> DataFrame:
    """A rule-made shift grid (values of a few metres, varying per node)."""
    ids = spark.range(GRID_N * GRID_N)
    return ids.select(
        (F.col("id") / GRID_N).cast("long").alias("i"),
        (F.col("id") % GRID_N).alias("j"),
    ).select(
        "i",
        "j",
        (((F.col("i") * 7 + F.col("j") * 13) % 97) * 1e-6 - 0.0002).alias("shift_lat"),
        (((F.col("i") * 11 + F.col("j") * 5) % 89) * 1e-6 - 0.0016).alias("shift_lon"),
    )


# ---------------------------------------------------------------------------
# DuckDB text
# ---------------------------------------------------------------------------

_WS = "'\\s'"


def _std(c: str) -> str:
    return f"upper(regexp_replace({c}, {_WS}, '', 'g'))"


def _strip0(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN (CASE WHEN ltrim({c}, '0') = '' THEN '0' ELSE ltrim({c}, '0') END) ELSE {c} END"


def _zfill(c: str, n: int) -> str:
    return f"CASE WHEN length({c}) >= {n} THEN {c} ELSE lpad({c}, {n}, '0') END"


def _nrn_parts(p: str, h: str, s: str) -> str:
    return f"({_zfill(_strip0(p), 4)}) || ({_zfill(_strip0(h), 3)}) || ({_zfill(_strip0(s), 3)})"


def _nrn_full(c: str) -> str:
    parts = [f"string_split({c}, '_')[{i}]" for i in (1, 2, 3)]
    return (
        f"CASE WHEN {c} IS NULL THEN NULL WHEN len(string_split({c}, '_')) = 3 THEN "
        f"({_zfill(parts[0], 4)}) || ({_zfill(parts[1], 3)}) || ({_zfill(parts[2], 3)}) "
        f"ELSE error('Unexpected NRN format: ' || {c}) END"
    )


def _sentinel(c: str, v: str) -> str:
    return f"CASE WHEN trim({c}) IS NULL OR trim({c}) = '{v}' OR TRY_CAST(trim({c}) AS DOUBLE) = {v} THEN NULL ELSE CAST(trim({c}) AS DOUBLE) END"


LOC_CTES = f""",
dir_typed AS (SELECT pcd, {_sentinel('lat', '99.999999')} AS lat, {_sentinel('long', '0.000000')} AS long, nation FROM directory),
model_typed AS (SELECT full_nrn, CAST(trim(latitude) AS DOUBLE) AS latitude, CAST(trim(longitude) AS DOUBLE) AS longitude, file_row, type FROM model),
map_std AS (SELECT *, {_std('postcode')} AS standardised_postcode FROM mapping),
map_valid AS (SELECT standardised_postcode, {_nrn_parts('primary_substation_id', 'hv_feeder_id', 'secondary_substation_id')} AS substation_nrn
  FROM map_std WHERE standardised_postcode IS NOT NULL AND length(standardised_postcode) >= 5),
dir_clean AS (SELECT {_std('pcd')} AS standardised_postcode, lat, long FROM dir_typed
  WHERE {_std('pcd')} IS NOT NULL AND lat IS NOT NULL AND long IS NOT NULL),
joined AS (SELECT m.standardised_postcode, m.substation_nrn, d.lat, d.long FROM map_valid m LEFT JOIN dir_clean d USING (standardised_postcode)),
located AS (SELECT * FROM joined WHERE lat IS NOT NULL AND long IS NOT NULL),
model_first AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY full_nrn
  ORDER BY (latitude IS NULL OR longitude IS NULL), file_row) AS rn FROM model_typed) WHERE rn = 1)
"""


def loc_with(*extra: str) -> str:
    return TD.duck_with("mapping", "directory", "model", *extra).rstrip("\n") + LOC_CTES


# ---------------------------------------------------------------------------
# postcodes and reference numbers
# ---------------------------------------------------------------------------


@register(
    "standardise_postcodes",
    "SC3, PR7",
    loc_with() + "SELECT dataset_id, postcode, standardised_postcode FROM map_std",
)
def standardise_postcodes(spark, sf):
    return mapping(spark, sf).select("dataset_id", "postcode", C.standardise_postcode("postcode").alias("standardised_postcode"))


@register(
    "invalid_postcodes",
    "FI1, FI2, AG4",
    loc_with()
    + "SELECT 'invalid_feeder_postcodes' AS metric, count(*) FILTER (WHERE standardised_postcode IS NULL OR length(standardised_postcode) < 5) AS value FROM map_std "
    "UNION ALL SELECT 'unmatched_feeder_postcodes' AS metric, count(DISTINCT CASE WHEN lat IS NULL OR long IS NULL THEN standardised_postcode END) AS value FROM joined",
)
def invalid_postcodes(spark, sf):
    m = mapping(spark, sf).withColumn("standardised_postcode", C.standardise_postcode("postcode"))
    valid = FI.valid_postcodes(m).select(
        "standardised_postcode",
        C.nrn_from_parts("primary_substation_id", "hv_feeder_id", "secondary_substation_id").alias("substation_nrn"),
    )
    d = directory(spark, sf).select(C.standardise_postcode("pcd").alias("standardised_postcode"), "lat", "long").dropna()
    return A.postcode_quality_stats(m, J.locate_postcodes(valid, d))


@register("locate_postcodes", "SC4, N8, JN3, FI2", loc_with() + "SELECT standardised_postcode, substation_nrn, lat, long FROM located")
def locate_postcodes(spark, sf):
    return L.postcode_points(mapping(spark, sf), directory(spark, sf))


@register(
    "nrn_from_parts",
    "PR9",
    loc_with() + f"SELECT dataset_id, {_nrn_parts('primary_substation_id', 'hv_feeder_id', 'secondary_substation_id')} AS substation_nrn FROM mapping",
)
def nrn_from_parts(spark, sf):
    m = mapping(spark, sf)
    return m.select("dataset_id", C.nrn_from_parts("primary_substation_id", "hv_feeder_id", "secondary_substation_id").alias("substation_nrn"))


@register("nrn_from_full", "SC5, PR8", loc_with() + f"SELECT full_nrn, {_nrn_full('full_nrn')} AS substation_nrn FROM model")
def nrn_from_full(spark, sf):
    return model(spark, sf).select("full_nrn", C.nrn_from_full("full_nrn").alias("substation_nrn"))


@register(
    "nrn_underscored",
    "PR10",
    loc_with()
    + "SELECT dataset_id, CASE WHEN primary_substation_id IS NULL OR hv_feeder_id IS NULL OR secondary_substation_id IS NULL THEN NULL "
    "ELSE primary_substation_id || '_' || hv_feeder_id || '_' || secondary_substation_id END AS nrn FROM mapping",
)
def nrn_underscored(spark, sf):
    m = mapping(spark, sf)
    return m.select("dataset_id", C.nrn_underscored("primary_substation_id", "hv_feeder_id", "secondary_substation_id").alias("nrn"))


@register("dedupe_model", "WN2, EX3", loc_with() + "SELECT full_nrn, latitude, longitude, file_row, type FROM model_first")
def dedupe_model(spark, sf):
    return W.dedupe_model(model(spark, sf))


@register(
    "mapping_stats",
    "AG2",
    loc_with() + "SELECT count(*) AS row_count, count(DISTINCT lv_feeder_name) AS nunique_feeders, count(DISTINCT postcode) AS nunique_postcodes FROM mapping",
)
def mapping_stats(spark, sf):
    return A.mapping_stats(mapping(spark, sf))


@register(
    "model_stats",
    "AG2",
    loc_with()
    + "SELECT count(*) AS row_count, count(DISTINCT full_nrn) AS nunique_substations, "
    "count(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) AS number_of_na_locations FROM model_typed",
)
def model_stats(spark, sf):
    return A.model_stats(model(spark, sf))


@register(
    "match_substations",
    "JN4",
    loc_with()
    + "SELECT DISTINCT m.substation_nrn, f.full_nrn, f.latitude, f.longitude FROM map_valid m "
    f"JOIN (SELECT *, {_nrn_full('full_nrn')} AS substation_nrn FROM model_first) f ON m.substation_nrn = f.substation_nrn",
)
def match_substations(spark, sf):
    m = mapping(spark, sf)
    nrns = FI.valid_postcodes(m.withColumn("standardised_postcode", C.standardise_postcode("postcode"))).select(
        C.nrn_from_parts("primary_substation_id", "hv_feeder_id", "secondary_substation_id").alias("substation_nrn")
    )
    first = W.dedupe_model(model(spark, sf)).withColumn("substation_nrn", C.nrn_from_full("full_nrn"))
    return J.match_substations(nrns, first.select("substation_nrn", "full_nrn", "latitude", "longitude"))


# ---------------------------------------------------------------------------
# hulls and measures
# ---------------------------------------------------------------------------


def _points_hull_sql() -> str:
    return TD.duck_with("points").rstrip("\n") + sqlgeo.hull_sql("points", "grp", "hp")


def point_hulls(spark, sf) -> DataFrame:
    return H.hull_measures(H.convex_hulls(TD.points(spark, sf), "grp"))


@register(
    "hull_stats",
    "GE3, GE5, GE6, GE7, GE8, AG13",
    _points_hull_sql() + "SELECT grp, geometry_type, coordinate_count, round(length_m, 3) AS length_m, round(area_m2, 3) AS area_m2 FROM hp_final",
)
def hull_stats(spark, sf):
    h = point_hulls(spark, sf)
    return h.select("grp", "geometry_type", "coordinate_count", F.round("length_m", 3).alias("length_m"), F.round("area_m2", 3).alias("area_m2"))


@register(
    "hull_centroid",
    "GE4, GE2 inverse",
    _points_hull_sql() + "SELECT grp, round(centroid_lon, 9) AS centroid_lon, round(centroid_lat, 9) AS centroid_lat FROM hp_final",
)
def hull_centroid(spark, sf):
    h = point_hulls(spark, sf)
    return h.select("grp", F.round(F.col("centroid")["x"], 9).alias("centroid_lon"), F.round(F.col("centroid")["y"], 9).alias("centroid_lat"))


@register(
    "plausible_areas",
    "FI9",
    _points_hull_sql()
    + "SELECT grp, geometry_type FROM hp_final WHERE geometry_type = 'Point' OR (geometry_type = 'LineString' AND length_m <= 100) "
    "OR (geometry_type = 'Polygon' AND area_m2 <= 10000 AND length_m / coordinate_count <= 100)",
)
def plausible_areas(spark, sf):
    return H.plausible_areas(point_hulls(spark, sf)).select("grp", "geometry_type")


@register(
    "area_quality_stats",
    "AG3, EX4",
    _points_hull_sql()
    + "SELECT count(*) AS nunique_substations, count(*) FILTER (WHERE geometry_type = 'Point') AS single_point_locations, "
    "count(*) FILTER (WHERE geometry_type = 'LineString') AS line_locations, count(*) FILTER (WHERE geometry_type = 'Polygon') AS polygon_locations, "
    "count(*) FILTER (WHERE geometry_type = 'LineString' AND length_m > 100) AS excluded_lines, "
    "count(*) FILTER (WHERE geometry_type = 'Polygon' AND area_m2 > 10000 AND length_m / coordinate_count > 100) AS excluded_polygons, "
    "count(*) FILTER (WHERE geometry_type = 'Polygon' AND (area_m2 > 10000 OR length_m / coordinate_count > 100)) AS excluded_polygons_actual FROM hp_final",
)
def area_quality_stats(spark, sf):
    return H.area_quality_stats(point_hulls(spark, sf))


@register(
    "postcode_locations",
    "GE12 (PR7, FI1, PR9, JN3, FI2, GE3, FI9, GE4, PR12)",
    loc_with().rstrip("\n")
    + sqlgeo.hull_sql("(SELECT substation_nrn, long AS x, lat AS y FROM located)", "substation_nrn", "hl")
    + "SELECT substation_nrn, printf('%.6f,%.6f', centroid_lat, centroid_lon) AS substation_geo_location FROM hl_final "
    "WHERE geometry_type = 'Point' OR (geometry_type = 'LineString' AND length_m <= 100) "
    "OR (geometry_type = 'Polygon' AND area_m2 <= 10000 AND length_m / coordinate_count <= 100)",
)
def postcode_locations(spark, sf):
    return L.substation_locations_from_postcodes(mapping(spark, sf), directory(spark, sf))


# ---------------------------------------------------------------------------
# projection, grid shift, distance join
# ---------------------------------------------------------------------------


@register(
    "project_bng",
    "GE1, GE2",
    loc_with()
    + f"SELECT pcd, round(v_e, 3) AS easting, round(v_n, 3) AS northing FROM (SELECT pcd, {', '.join(sqlgeo.project_sql('long', 'lat', 'v'))} "
    "FROM dir_typed WHERE lat IS NOT NULL AND long IS NOT NULL)",
)
def project_bng(spark, sf):
    d = FI.located(directory(spark, sf))
    p = G.project_point(C.point("long", "lat"))
    return d.select("pcd", F.round(p["x"], 3).alias("easting"), F.round(p["y"], 3).alias("northing"))


@register(
    "offset_metres",
    "GE11",
    loc_with()
    + f"SELECT pcd, round(sqrt((a_e - b_e) * (a_e - b_e) + (a_n - b_n) * (a_n - b_n)), 3) AS offset_m FROM (SELECT pcd, "
    f"{', '.join(sqlgeo.project_sql('long', 'lat', 'a'))}, {', '.join(sqlgeo.project_sql('long + 0.001', 'lat + 0.0005', 'b'))} "
    "FROM dir_typed WHERE lat IS NOT NULL AND long IS NOT NULL)",
)
def offset_metres(spark, sf):
    d = FI.located(directory(spark, sf))
    a = C.point("long", "lat")
    b = C.point(F.col("long") + 0.001, F.col("lat") + 0.0005)
    return d.select("pcd", F.round(G.offset_metres(a, b), 3).alias("offset_m"))


_GRID_SQL = f""",
grid AS (SELECT CAST(id // {GRID_N} AS BIGINT) AS i, CAST(id % {GRID_N} AS BIGINT) AS j,
  ((id // {GRID_N}) * 7 + (id % {GRID_N}) * 13) % 97 * 1e-6 - 0.0002 AS shift_lat,
  ((id // {GRID_N}) * 11 + (id % {GRID_N}) * 5) % 89 * 1e-6 - 0.0016 AS shift_lon
  FROM range({GRID_N * GRID_N}) t(id)),
pts AS (SELECT file_row, latitude, longitude, (latitude - {GRID_SPEC.lat0}) / {GRID_SPEC.dlat} AS fi, (longitude - {GRID_SPEC.lon0}) / {GRID_SPEC.dlon} AS fj
  FROM model_first WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
cor AS (SELECT file_row, latitude, longitude, CAST(floor(fi) AS BIGINT) + di AS i, CAST(floor(fj) AS BIGINT) + dj AS j,
  CASE WHEN di = 0 THEN 1 - (fi - floor(fi)) ELSE fi - floor(fi) END * CASE WHEN dj = 0 THEN 1 - (fj - floor(fj)) ELSE fj - floor(fj) END AS w
  FROM pts, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) c(di, dj)),
shifted AS (SELECT file_row, latitude + sum(w * g.shift_lat) AS latitude, longitude + sum(w * g.shift_lon) AS longitude
  FROM cor LEFT JOIN grid g USING (i, j) GROUP BY file_row, cor.latitude, cor.longitude)
"""


@register(
    "grid_shift",
    "GE9",
    loc_with() + _GRID_SQL + "SELECT file_row, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude FROM shifted",
)
def grid_shift_q(spark, sf):
    first = FI.located(W.dedupe_model(model(spark, sf)), "latitude", "longitude")
    out = grid_shift(first, shift_grid(spark), GRID_SPEC)
    return out.select("file_row", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


@register(
    "model_locations",
    "GE13 (WN2, FI2, PR8, GE9, PR12, EX2)",
    loc_with()
    + _GRID_SQL
    + f""", fmt AS (SELECT {_nrn_full('m.full_nrn')} AS substation_nrn, printf('%.6f,%.6f', s.latitude, s.longitude) AS substation_geo_location, s.file_row
  FROM shifted s JOIN model_first m USING (file_row))
SELECT substation_nrn, substation_geo_location, 'grid' AS method FROM (SELECT *, row_number() OVER (PARTITION BY substation_nrn ORDER BY file_row) AS rn FROM fmt) WHERE rn = 1""",
)
def model_locations(spark, sf):
    return L.substation_locations_from_model(model(spark, sf), shift_grid(spark), GRID_SPEC)


def _nation_hulls(spark, sf) -> DataFrame:
    """Areas: hull (lon/lat) of each nation's suppliers' directory points."""
    d = R.postcode_directory_from_text(TD.view(spark, sf, "directory"), ["nation", "lat", "long"]).dropna()
    pts = d.select(F.col("nation").alias("polygon_id"), F.col("long").alias("x"), F.col("lat").alias("y"))
    return H.convex_hulls(pts, "polygon_id")


def _nation_areas(spark, sf) -> DataFrame:
    """The same areas with rings in BNG metres."""
    return _nation_hulls(spark, sf).select("polygon_id", H.project_hull("hull").alias("ring"))


_WITHIN_SQL = (
    loc_with().rstrip("\n")
    + sqlgeo.hull_sql("(SELECT nation, long AS x, lat AS y FROM dir_typed WHERE lat IS NOT NULL AND long IS NOT NULL)", "nation", "na")
    + f""", pts AS (SELECT file_row AS point_id, {", ".join(sqlgeo.project_sql("longitude", "latitude", "q"))}
  FROM model_first WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
seg AS (SELECT p.point_id, e.k AS polygon_id, e.ae, e.an, e.be - e.ae AS dx, e.bn - e.an AS dy, e.be, e.bn, p.q_e AS px, p.q_n AS py FROM pts p, na_pe e),
segt AS (SELECT *, CASE WHEN dx * dx + dy * dy = 0 THEN 0.0 ELSE ((px - ae) * dx + (py - an) * dy) / (dx * dx + dy * dy) END AS t0 FROM seg),
segd AS (SELECT point_id, polygon_id,
  (px - (ae + least(greatest(t0, 0.0), 1.0) * dx)) * (px - (ae + least(greatest(t0, 0.0), 1.0) * dx))
  + (py - (an + least(greatest(t0, 0.0), 1.0) * dy)) * (py - (an + least(greatest(t0, 0.0), 1.0) * dy)) AS d2,
  CASE WHEN ((an > py) <> (bn > py)) AND px < ae + (py - an) * (be - ae) / (bn - an) THEN 1 ELSE 0 END AS cross1 FROM segt),
poly AS (SELECT s.point_id, s.polygon_id, CASE WHEN n.nedges >= 3 AND sum(s.cross1) % 2 = 1 THEN 0.0 ELSE sqrt(min(s.d2)) END AS distance_m
  FROM segd s JOIN na_n n ON s.polygon_id = n.k GROUP BY s.point_id, s.polygon_id, n.nedges),
single AS (SELECT p.point_id, v.k AS polygon_id, sqrt((p.q_e - v.v_e) * (p.q_e - v.v_e) + (p.q_n - v.v_n) * (p.q_n - v.v_n)) AS distance_m
  FROM pts p, na_v v JOIN na_n n ON v.k = n.k WHERE n.npts = 1)
SELECT point_id, polygon_id, round(distance_m, 3) AS distance_m FROM (SELECT * FROM poly UNION ALL SELECT * FROM single) WHERE distance_m <= 1000.0"""
)


@register("within_distance", "JN5 (polygon cover, exact distance)", _WITHIN_SQL)
def within_distance_q(spark, sf):
    first = FI.located(W.dedupe_model(model(spark, sf)), "latitude", "longitude")
    p = G.project_point(C.point("longitude", "latitude"))
    pts = first.select(F.col("file_row").alias("point_id"), p["x"].alias("x"), p["y"].alias("y"))
    areas = scratch_table(_nation_areas(spark, sf), "nation-areas")  # cover and edges both read it
    pairs = SP.within_distance_pairs(pts, areas, 1000.0, cell=10_000.0)
    return pairs.select("point_id", "polygon_id", F.round("distance_m", 3).alias("distance_m"))


@register(
    "coverage_sets",
    "JN6, JB9",
    TD.duck_with("ssen_readings", "lookup_postcodes", "lookup_model")
    + """, al AS (SELECT DISTINCT substr(dataset_id, 1, 10) AS k FROM ssen_readings),
a AS (SELECT DISTINCT substation_nrn AS k FROM lookup_postcodes WHERE substation_geo_location IS NOT NULL),
b AS (SELECT DISTINCT substation_nrn AS k FROM lookup_model WHERE substation_geo_location IS NOT NULL),
u AS (SELECT k FROM al UNION SELECT k FROM a UNION SELECT k FROM b),
f AS (SELECT u.k, a.k IS NOT NULL AS in_a, b.k IS NOT NULL AS in_b FROM u LEFT JOIN a ON u.k = a.k LEFT JOIN b ON u.k = b.k)
SELECT count(*) AS n_ids, count(*) FILTER (WHERE in_a) AS n_a, count(*) FILTER (WHERE in_b) AS n_b, count(*) FILTER (WHERE in_a AND in_b) AS n_both,
  count(*) FILTER (WHERE NOT in_a AND NOT in_b) AS n_neither, count(*) FILTER (WHERE in_a AND NOT in_b) AS n_a_only,
  count(*) FILTER (WHERE NOT in_a AND in_b) AS n_b_only FROM f""",
)
def coverage_sets(spark, sf):
    ids = TD.ssen_readings(spark, sf).select(C.substation_nrn_from_dataset("dataset_id").alias("substation_nrn"))
    return L.location_coverage(ids, TD.view(spark, sf, "lookup_postcodes"), TD.view(spark, sf, "lookup_model"))


@register(
    "not_primary",
    "FI10",
    loc_with() + "SELECT full_nrn, file_row, type FROM model_typed WHERE type IS DISTINCT FROM 'Primary'",
)
def not_primary(spark, sf):
    return FI.not_primary(model(spark, sf), "type").select("full_nrn", "file_row", "type")


@register(
    "id_set_ops",
    "SE4, SE5",
    loc_with()
    + f""", a AS (SELECT DISTINCT {_nrn_parts('primary_substation_id', 'hv_feeder_id', 'secondary_substation_id')} AS k FROM mapping),
b AS (SELECT DISTINCT {_nrn_full('full_nrn')} AS k FROM model)
SELECT 'both' AS op, k AS substation_nrn FROM (SELECT k FROM a INTERSECT SELECT k FROM b)
UNION ALL SELECT 'mapping_only', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
UNION ALL SELECT 'model_only', k FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""",
)
def id_set_ops(spark, sf):
    from ..operators import setops as SE

    a = mapping(spark, sf).select(C.nrn_from_parts("primary_substation_id", "hv_feeder_id", "secondary_substation_id").alias("substation_nrn"))
    b = model(spark, sf).select(C.nrn_from_full("full_nrn").alias("substation_nrn"))
    both = SE.intersect_ids(a, b).select(F.lit("both").alias("op"), "substation_nrn")
    a_only = SE.difference_ids(a, b, "substation_nrn").select(F.lit("mapping_only").alias("op"), "substation_nrn")
    b_only = SE.difference_ids(b, a, "substation_nrn").select(F.lit("model_only").alias("op"), "substation_nrn")
    return both.unionByName(a_only).unionByName(b_only)


def _d2(px: str, py: str, a: str) -> str:
    """Squared distance of a point to the edge of ``a``, as SQL."""
    dx, dy = f"({a}.be - {a}.ae)", f"({a}.bn - {a}.an)"
    len2 = f"({dx} * {dx} + {dy} * {dy})"
    t = f"CASE WHEN {len2} = 0 THEN 0.0 ELSE least(greatest((({px} - {a}.ae) * {dx} + ({py} - {a}.an) * {dy}) / {len2}, 0.0), 1.0) END"
    return f"(({px} - ({a}.ae + {t} * {dx})) ** 2 + ({py} - ({a}.an + {t} * {dy})) ** 2)"


def _turn(a: str, px: str, py: str) -> str:
    return f"sign(({a}.be - {a}.ae) * ({py} - {a}.an) - ({a}.bn - {a}.an) * ({px} - {a}.ae))"


def _ray(px: str, py: str, a: str) -> str:
    """Whether the ray to the right of a point meets the edge of ``a``, as SQL."""
    return f"CASE WHEN (({a}.an > {py}) <> ({a}.bn > {py})) AND {px} < {a}.ae + ({py} - {a}.an) * ({a}.be - {a}.ae) / ({a}.bn - {a}.an) THEN 1 ELSE 0 END"


# every edge of a substation's hull with every edge of an area, plainly
_LICENSE_SQL = (
    loc_with().rstrip("\n")
    + sqlgeo.hull_sql("(SELECT substation_nrn, long AS x, lat AS y FROM located)", "substation_nrn", "hl")
    + sqlgeo.hull_sql("(SELECT nation, long AS x, lat AS y FROM dir_typed WHERE lat IS NOT NULL AND long IS NOT NULL)", "nation", "na")
    + f""", subs AS (SELECT substation_nrn, geometry_type, length_m FROM hl_final WHERE geometry_type = 'Point'
  OR (geometry_type = 'LineString' AND length_m < 100) OR (geometry_type = 'Polygon' AND length_m / coordinate_count < 100)),
se AS (SELECT k, ae, an, be, bn FROM hl_pe UNION ALL SELECT v.k, v_e, v_n, v_e, v_n FROM hl_v v JOIN hl_n n ON v.k = n.k WHERE n.npts = 1),
pe AS (SELECT k, ae, an, be, bn FROM na_pe UNION ALL SELECT v.k, v_e, v_n, v_e, v_n FROM na_v v JOIN na_n n ON v.k = n.k WHERE n.npts = 1),
pairs AS (SELECT s.k AS sk, p.k AS pk, s.ae AS sx, s.an AS sy, p.ae AS px, p.an AS py,
  least({_d2("s.ae", "s.an", "p")}, {_d2("s.be", "s.bn", "p")}, {_d2("p.ae", "p.an", "s")}, {_d2("p.be", "p.bn", "s")}) AS d2,
  {_turn("s", "p.ae", "p.an")} * {_turn("s", "p.be", "p.bn")} < 0 AND {_turn("p", "s.ae", "s.an")} * {_turn("p", "s.be", "s.bn")} < 0 AS across,
  {_ray("s.ae", "s.an", "p")} AS out_ray, {_ray("p.ae", "p.an", "s")} AS in_ray FROM se s, pe p),
near AS (SELECT sk FROM pairs WHERE across OR sqrt(d2) <= 1000.0
  UNION SELECT sk FROM pairs JOIN na_n n ON n.k = pk WHERE n.nedges >= 3 GROUP BY sk, pk, sx, sy HAVING sum(out_ray) % 2 = 1
  UNION SELECT sk FROM pairs JOIN hl_n n ON n.k = sk WHERE n.nedges >= 3 GROUP BY sk, pk, px, py HAVING sum(in_ray) % 2 = 1)
SELECT substation_nrn, geometry_type, round(length_m, 3) AS length_m FROM subs WHERE substation_nrn IN (SELECT sk FROM near)"""
)


@register("license_area_locations", "GE14 (ADR form; whole areas)", _LICENSE_SQL)
def license_area_locations(spark, sf):
    lonlat = _nation_hulls(spark, sf).select("polygon_id", F.col("hull").alias("ring"))
    out = L.license_area_locations(mapping(spark, sf), directory(spark, sf), lonlat, distance_m=1000.0, cell_m=10_000.0)
    return out.select("substation_nrn", "geometry_type", F.round("length_m", 3).alias("length_m"))
