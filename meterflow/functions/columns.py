"""Column -> Column helpers for the text, id and number rules of the data.

All helpers build JVM-side expressions, so they stay inside whole-stage
codegen; none of them calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- text and ids -------------------------------------------------------------


def blank_to_null(c: Column | str, tokens: list[str] | None = None) -> Column:
    """Null out the "no value" text tokens (rule N2)."""
    c = col_of(c)
    return F.when(c.isin(tokens or S.NGED_BLANK_TOKENS), F.lit(None).cast("string")).otherwise(c)


def zfill(c: Column | str, width: int) -> Column:
    """Left-pad with zeros to ``width`` and never truncate (``str.zfill``).

    ``lpad`` alone would cut a longer value down to ``width``.
    """
    c = col_of(c)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def strip_leading_zeros(c: Column | str) -> Column:
    """'0001' -> '1', '0000' -> '0'; non-digit text unchanged.

    CSV readers that infer integers turn digit-only ids into numbers; the
    padding rules below expect that form.
    """
    c = col_of(c)
    stripped = F.regexp_replace(c, r"^0+", "")
    stripped = F.when(stripped == "", F.lit("0")).otherwise(stripped)
    return F.when(c.rlike(r"^[0-9]+$"), stripped).otherwise(c)


def nrn_from_parts(primary: Column | str, hv_feeder: Column | str, secondary: Column | str) -> Column:
    """Substation network reference number: zero-padded 4 + 3 + 3 (PR9)."""
    parts = [strip_leading_zeros(primary), strip_leading_zeros(hv_feeder), strip_leading_zeros(secondary)]
    return F.concat(zfill(parts[0], 4), zfill(parts[1], 3), zfill(parts[2], 3))


def nrn_from_full(full_nrn: Column | str, strict: bool = True) -> Column:
    """'a_b_c' -> zero-padded 4 + 3 + 3 (PR8); any other shape is an error."""
    c = col_of(full_nrn)
    parts = F.split(c, "_")
    nrn = F.concat(zfill(parts.getItem(0), 4), zfill(parts.getItem(1), 3), zfill(parts.getItem(2), 3))
    if not strict:
        return F.when(F.size(parts) == 3, nrn)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(F.size(parts) == 3, nrn).otherwise(
        F.raise_error(F.concat(F.lit("not three parts joined by _: "), c))
    )


def nrn_underscored(primary: Column | str, hv_feeder: Column | str, secondary: Column | str) -> Column:
    """'p_h_s' form of the reference number (PR10); null when a part is null."""
    p, h, s = col_of(primary), col_of(hv_feeder), col_of(secondary)
    return F.when(p.isNull() | h.isNull() | s.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat_ws("_", p, h, s)
    )


def substation_nrn_from_dataset(dataset_id: Column | str) -> Column:
    """First 10 characters of an SSEN dataset id (PR5)."""
    return F.substring(col_of(dataset_id), 1, 10)


def standardise_postcode(c: Column | str) -> Column:
    """Trim, delete every whitespace character, uppercase (PR7)."""
    return F.upper(F.regexp_replace(col_of(c), r"(?U)\s", ""))


def filename_from_url(url: Column | str) -> Column:
    """Last path segment of a URL (PR15)."""
    return F.element_at(F.split(col_of(url), "/"), -1)


def month_from_ssen_url(url: Column | str) -> Column:
    """'.../YYYY-MM-DD.csv' -> DATE 'YYYY-MM-01' (PR16, SSEN)."""
    name = filename_from_url(url)
    ym = F.regexp_extract(name, r"^(\d{4})-(\d{2})-\d{2}", 0)
    return F.when(ym == "", F.lit(None).cast("date")).otherwise(
        F.to_date(F.concat(F.substring(name, 1, 7), F.lit("-01")))
    )


def month_from_nged_url(url: Column | str) -> Column:
    """7th and 8th '-'-separated parts of the file name -> DATE (PR16, NGED)."""
    parts = F.split(filename_from_url(url), "-")
    return F.when(F.size(parts) < 8, F.lit(None).cast("date")).otherwise(
        F.to_date(F.concat(parts.getItem(6), F.lit("-"), F.substring(parts.getItem(7), 1, 2), F.lit("-01")))
    )


def month_from_url(url: Column | str, dno: str) -> Column:
    dno = dno.upper()
    if dno == "SSEN":
        return month_from_ssen_url(url)
    if dno == "NGED":
        return month_from_nged_url(url)
    raise ValueError(f"no file name rule is known for network operator {dno}")


# -- locations ----------------------------------------------------------------


def point(x: Column | str, y: Column | str) -> Column:
    """Point struct (x = longitude, y = latitude); null if either is null (GE1)."""
    x, y = col_of(x), col_of(y)
    return F.when(x.isNull() | y.isNull(), F.lit(None).cast(S.POINT_TYPE)).otherwise(
        F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    )


def location_lat_text(loc: Column | str) -> Column:
    return F.split(col_of(loc), ",", 2).getItem(0)


def location_lng_text(loc: Column | str) -> Column:
    return F.split(col_of(loc), ",", 2).getItem(1)


def parse_location(loc: Column | str) -> Column:
    """'lat,lng' text -> point(x=lng, y=lat); null text -> null point (PR11)."""
    c = col_of(loc)
    lat = F.trim(location_lat_text(c)).cast("double")
    lng = F.trim(location_lng_text(c)).cast("double")
    return point(lng, lat)


def format_location(lat: Column | str, lng: Column | str) -> Column:
    """'%.6f,%.6f' of (lat, lng) (PR12)."""
    lat, lng = col_of(lat), col_of(lng)
    return F.when(lat.isNull() | lng.isNull(), F.lit(None).cast("string")).otherwise(
        F.format_string("%.6f,%.6f", lat.cast("double"), lng.cast("double"))
    )


# -- numbers ------------------------------------------------------------------


def round_half_even_long(c: Column | str) -> Column:
    """Round half to even, to int64; NaN becomes null first (PR13, rule N9)."""
    c = col_of(c)
    return F.when(F.isnan(c), F.lit(None).cast("long")).otherwise(F.bround(c, 0).cast("long"))


def wh_to_kwh(c: Column | str) -> Column:
    """Wh -> kWh (PR19)."""
    return col_of(c) / F.lit(1000.0)


def normalised(consumption: Column | str, devices: Column | str) -> Column:
    """Consumption per device (PR20); null instead of infinity when devices is 0."""
    return F.try_divide(col_of(consumption).cast("double"), col_of(devices).cast("double"))


def null_join(sep: str, *cols: Column | str) -> Column:
    """Join with ``sep``; null if any part is null (rule N4)."""
    pieces: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(col_of(c))
    return F.concat(*pieces)


def count_distinct_with_null(c: Column | str) -> Column:
    """Distinct values where null counts as one value (rule N6, set semantics)."""
    c = col_of(c)
    return F.count_distinct(c) + F.max(c.isNull().cast("int"))
