"""Row filters (FI1-FI11). All are plain predicates, so Catalyst pushes them
into the Parquet scan (PushedFilters) and prunes ``month=`` folders."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.timefns import month_bounds

TS = "data_collection_log_timestamp"


def valid_postcodes(df: DataFrame, column: str = "standardised_postcode") -> DataFrame:
    """Drop null or too-short postcodes (FI1)."""
    c = F.col(column)
    return df.where(c.isNotNull() & (F.length(c) >= S.SHORTEST_POSTCODE))


def invalid_postcode_flag(column: str = "standardised_postcode") -> Column:
    c = F.col(column)
    return c.isNull() | (F.length(c) < S.SHORTEST_POSTCODE)


def located(df: DataFrame, lat: str = "lat", lng: str = "long") -> DataFrame:
    """Drop rows without both coordinates (FI2)."""
    return df.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())


def _as_text(value) -> str:
    """Timestamps travel as ISO text (aware ones in UTC), so the cast to the
    column's type never depends on the Python process's local zone."""
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return str(value)


def _ts_literal(value: str | dt.datetime | dt.date, like: DataFrame | None = None, column: str = TS) -> Column:
    lit = F.lit(_as_text(value))
    if like is not None:
        return lit.cast(like.schema[column].dataType)
    return lit.cast("timestamp")


def utc_range(df: DataFrame, start, end, column: str = TS) -> DataFrame:
    """Half-open [start, end) on the timestamp column."""
    c = F.col(column)
    return df.where((c >= _ts_literal(start, df, column)) & (c < _ts_literal(end, df, column)))


def utc_month(df: DataFrame, month: str, column: str = TS) -> DataFrame:
    """Rows inside one UTC month (FI3)."""
    start, end = month_bounds(month)
    return utc_range(df, start, end, column)


def utc_day(df: DataFrame, day: str, column: str = TS) -> DataFrame:
    d = dt.date.fromisoformat(day)
    return utc_range(df, d.isoformat(), (d + dt.timedelta(days=1)).isoformat(), column)


def settlement_period(df: DataFrame, when, column: str = TS) -> DataFrame:
    """Rows of exactly one half hour (FI4)."""
    return df.where(F.col(column) == _ts_literal(when, df, column))


_OPS = {
    "=": lambda c, v: c == v,
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
    "not in": lambda c, v: ~c.isin(list(v)),
}


def _clauses(filters) -> list[list[tuple]]:
    if not filters:
        return []
    if isinstance(filters[0], tuple):
        return [list(filters)]
    return [list(f) for f in filters]


def dnf_predicate(filters, df: DataFrame | None = None) -> Column:
    """[(col, op, value)] is an AND; [[...], [...]] is an OR of ANDs (FI5).

    A null cell never passes (SQL three-valued logic)."""

    def one(term):
        name, op, value = term
        if op not in _OPS:
            raise ValueError(f"Unsupported operator: {op}")
        col = F.col(name)
        if df is not None and not isinstance(value, (list, tuple, set)):
            typ = df.schema[name].dataType.simpleString() if name in df.columns else None
            if typ in ("timestamp", "timestamp_ntz", "date"):
                value = F.lit(_as_text(value)).cast(typ)
        # no coalesce: a WHERE drops null results anyway (Kleene logic, as Arrow
        # filters), and a bare comparison can be pushed into the Parquet scan
        return _OPS[op](col, value)

    return reduce(or_, [reduce(and_, [one(t) for t in clause]) for clause in _clauses(filters)])


def dnf_filter(df: DataFrame, filters) -> DataFrame:
    return df.where(dnf_predicate(filters, df))


def month_predicate_from_filters(filters, column: str = TS, month_column: str = "month") -> Column | None:
    """Month-folder predicate implied by timestamp bounds in ``filters``.

    Catalyst cannot infer folder values from a timestamp predicate, so a
    bound on the timestamp is restated on the ``month`` partition column.
    """
    preds = []
    for clause in _clauses(filters):
        lo = hi = None
        for name, op, value in clause:
            if name != column:
                continue
            d = value if isinstance(value, (dt.datetime, dt.date)) else dt.datetime.fromisoformat(str(value).replace("Z", "+00:00"))
            if isinstance(d, dt.datetime) and d.tzinfo is not None:  # folders are UTC months
                d = d.astimezone(dt.timezone.utc)
            first = dt.date(d.year, d.month, 1)
            if op in ("=", "=="):
                lo = hi = first
            elif op in (">", ">="):
                lo = first
            elif op in ("<", "<="):
                hi = first
        m = F.col(month_column)
        p = F.lit(True)
        if lo is not None:
            p = p & (m >= F.lit(lo))
        if hi is not None:
            p = p & (m <= F.lit(hi))
        preds.append(p)
    if not preds:
        return None
    return reduce(or_, preds)


def bbox_predicate(minx: float, miny: float, maxx: float, maxy: float, geometry: str = "geometry") -> Column:
    g = F.col(geometry)
    return g["x"].between(minx, maxx) & g["y"].between(miny, maxy)


def bbox_filter(df: DataFrame, minx: float, miny: float, maxx: float, maxy: float, geometry: str = "geometry") -> DataFrame:
    """Points inside (min_x, min_y, max_x, max_y), edges included (FI6, GE10)."""
    return df.where(bbox_predicate(minx, miny, maxx, maxy, geometry))


def in_list(df: DataFrame, column: str, values) -> DataFrame:
    """Membership in a list or in another DataFrame's column (FI7).

    A DataFrame is matched with a left-semi join; whether it is broadcast is
    left to Spark's check of its size.
    """
    if isinstance(values, DataFrame):
        ids = values.select(F.col(values.columns[0]).alias("__id")).distinct()
        return df.join(ids, F.col(column) == F.col("__id"), "left_semi")
    return df.where(F.col(column).isin(list(values)))


def drop_outliers(df: DataFrame, column: str = "total_consumption_active_import", limit: float = S.OUTLIER_WH) -> DataFrame:
    """Keep values below the outlier cut (FI8); null values are dropped too."""
    return df.where(F.col(column) < limit)


def not_primary(df: DataFrame, column: str = "Type") -> DataFrame:
    """Drop Type = Primary; a null Type stays (FI10)."""
    return df.where(~F.col(column).eqNullSafe("Primary"))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is null or blank (FI11)."""
    c = F.col(column)
    return df.where(c.isNull() | (c == ""))
