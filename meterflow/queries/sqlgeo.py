"""The British National Grid series of ``functions.geo`` as DuckDB SQL text,
for the oracle side of the geometry queries. Same constants, same formulas."""

from __future__ import annotations

from .. import schemas as S
from ..functions import geo as G


def _f(v: float) -> str:
    return repr(float(v))


def project_sql(lon: str, lat: str, prefix: str) -> list[str]:
    """Select-list items (DuckDB lateral aliases) ending in {prefix}_e, {prefix}_n."""
    p = prefix
    items = [
        f"radians({lat}) AS {p}_phi",
        f"radians({lon}) - {_f(G._LAM0)} AS {p}_lam",
        f"sinh(asinh(tan({p}_phi)) - {_f(G._E)} * atanh({_f(G._E)} * sin({p}_phi))) AS {p}_tau",
        f"atan2({p}_tau, cos({p}_lam)) AS {p}_xip",
        f"asinh(sin({p}_lam) / sqrt({p}_tau * {p}_tau + cos({p}_lam) * cos({p}_lam))) AS {p}_etap",
    ]
    xi = f"{p}_xip" + "".join(
        f" + {_f(a)} * sin({2 * j} * {p}_xip) * cosh({2 * j} * {p}_etap)" for j, a in enumerate(G._ALPHA, start=1)
    )
    eta = f"{p}_etap" + "".join(
        f" + {_f(a)} * cos({2 * j} * {p}_xip) * sinh({2 * j} * {p}_etap)" for j, a in enumerate(G._ALPHA, start=1)
    )
    k = S.BNG_K0 * G._RECT
    items += [
        f"{_f(S.BNG_E0)} + {_f(k)} * ({eta}) AS {p}_e",
        f"{_f(S.BNG_N0)} + {_f(k)} * (({xi}) - {_f(G._XI0)}) AS {p}_n",
    ]
    return items


def unproject_sql(e: str, n: str, prefix: str) -> list[str]:
    """Select-list items ending in {prefix}_lon, {prefix}_lat."""
    p = prefix
    k = S.BNG_K0 * G._RECT
    items = [
        f"({n} - {_f(S.BNG_N0)}) / {_f(k)} + {_f(G._XI0)} AS {p}_xi",
        f"({e} - {_f(S.BNG_E0)}) / {_f(k)} AS {p}_eta",
    ]
    xip = f"{p}_xi" + "".join(
        f" - {_f(b)} * sin({2 * j} * {p}_xi) * cosh({2 * j} * {p}_eta)" for j, b in enumerate(G._BETA, start=1)
    )
    etap = f"{p}_eta" + "".join(
        f" - {_f(b)} * cos({2 * j} * {p}_xi) * sinh({2 * j} * {p}_eta)" for j, b in enumerate(G._BETA, start=1)
    )
    items += [
        f"{xip} AS {p}_xip",
        f"{etap} AS {p}_etap",
        f"asin(sin({p}_xip) / cosh({p}_etap)) AS {p}_chi",
        f"degrees(atan2(sinh({p}_etap), cos({p}_xip)) + {_f(G._LAM0)}) AS {p}_lon",
        f"degrees({p}_chi" + "".join(f" + {_f(d)} * sin({2 * j} * {p}_chi)" for j, d in enumerate(G._DELTA, start=1)) + f") AS {p}_lat",
    ]
    return items


def hull_sql(points: str, key: str, out: str) -> str:
    """CTEs computing, from ``points``(key, x, y) in degrees, one row per key:
    geometry_type, coordinate_count, length_m, area_m2, centroid lon/lat.

    Hull edges by the edge test: a directed pair (a, b) of distinct points is
    a counter-clockwise hull edge iff no point lies strictly to its right and
    no collinear point lies beyond either end.
    """
    proj = ", ".join(project_sql("x", "y", "v"))
    return f""",
{out}_p AS (SELECT DISTINCT {key} AS k, x, y FROM {points}),
{out}_v AS (SELECT k, x, y, {proj} FROM {out}_p),
{out}_e AS (SELECT a.k, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by FROM {out}_p a JOIN {out}_p b ON a.k = b.k AND (a.x <> b.x OR a.y <> b.y)
  WHERE NOT EXISTS (SELECT 1 FROM {out}_p r WHERE r.k = a.k AND (
    (b.x - a.x) * (r.y - a.y) - (b.y - a.y) * (r.x - a.x) < 0
    OR ((b.x - a.x) * (r.y - a.y) - (b.y - a.y) * (r.x - a.x) = 0
        AND ((r.x - a.x) * (b.x - a.x) + (r.y - a.y) * (b.y - a.y) < 0 OR (r.x - b.x) * (a.x - b.x) + (r.y - b.y) * (a.y - b.y) < 0))))),
{out}_n AS (SELECT p.k, count(DISTINCT (p.x, p.y)) AS npts, count(e.k) AS nedges FROM {out}_p p LEFT JOIN {out}_e e ON p.k = e.k AND p.x = e.ax AND p.y = e.ay GROUP BY p.k),
{out}_ref AS (SELECT k, arg_min(v_e, struct_pack(x := x, y := y)) AS rx, arg_min(v_n, struct_pack(x := x, y := y)) AS ry, min(struct_pack(x := x, y := y)) AS r0 FROM {out}_v GROUP BY k),
{out}_pe AS (SELECT e.k, va.v_e AS ae, va.v_n AS an, vb.v_e AS be, vb.v_n AS bn,
  (va.x < vb.x OR (va.x = vb.x AND va.y < vb.y)) AS fwd
  FROM {out}_e e JOIN {out}_v va ON va.k = e.k AND va.x = e.ax AND va.y = e.ay JOIN {out}_v vb ON vb.k = e.k AND vb.x = e.bx AND vb.y = e.by),
{out}_agg AS (SELECT pe.k,
  sum(sqrt((be - ae) * (be - ae) + (bn - an) * (bn - an))) AS perim,
  sum((ae - r.rx) * (bn - r.ry) - (be - r.rx) * (an - r.ry)) AS cross2,
  sum(((ae - r.rx) + (be - r.rx)) * ((ae - r.rx) * (bn - r.ry) - (be - r.rx) * (an - r.ry))) AS cxs,
  sum(((an - r.ry) + (bn - r.ry)) * ((ae - r.rx) * (bn - r.ry) - (be - r.rx) * (an - r.ry))) AS cys,
  max(CASE WHEN fwd THEN (ae + be) / 2 END) AS mide, max(CASE WHEN fwd THEN (an + bn) / 2 END) AS midn
  FROM {out}_pe pe JOIN {out}_ref r ON pe.k = r.k GROUP BY pe.k),
{out} AS (SELECT n.k AS {key},
  CASE WHEN n.npts = 1 THEN 'Point' WHEN n.nedges = 2 THEN 'LineString' ELSE 'Polygon' END AS geometry_type,
  CASE WHEN n.npts = 1 THEN 1 WHEN n.nedges = 2 THEN 2 ELSE n.nedges + 1 END AS coordinate_count,
  CASE WHEN n.npts = 1 THEN 0.0 WHEN n.nedges = 2 THEN a.perim / 2 ELSE a.perim END AS length_m,
  CASE WHEN n.npts = 1 OR n.nedges = 2 THEN 0.0 ELSE abs(a.cross2) / 2 END AS area_m2,
  CASE WHEN n.npts = 1 THEN NULL WHEN n.nedges = 2 THEN a.mide ELSE r.rx + a.cxs / (3 * a.cross2) END AS ce,
  CASE WHEN n.npts = 1 THEN NULL WHEN n.nedges = 2 THEN a.midn ELSE r.ry + a.cys / (3 * a.cross2) END AS cn,
  r.r0.x AS px, r.r0.y AS py, n.npts
  FROM {out}_n n JOIN {out}_ref r ON n.k = r.k LEFT JOIN {out}_agg a ON n.k = a.k),
{out}_c AS (SELECT *, {", ".join(unproject_sql("ce", "cn", "u"))} FROM {out}),
{out}_final AS (SELECT {key}, geometry_type, coordinate_count, length_m, area_m2,
  CASE WHEN npts = 1 THEN px ELSE u_lon END AS centroid_lon, CASE WHEN npts = 1 THEN py ELSE u_lat END AS centroid_lat FROM {out}_c)
"""
