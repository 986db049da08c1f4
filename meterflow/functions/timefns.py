"""Timestamp floors that keep the input type.

``date_trunc`` always returns a zoned TIMESTAMP, even for TIMESTAMP_NTZ input.
Subtracting a day-time interval keeps the input type (zoned or not), so the
same helper works for the published UTC data and for naive test data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col_of


def _seconds(c: Column) -> Column:
    # DECIMAL(8,6): whole and fractional seconds of the minute
    return F.date_part(F.lit("SECOND"), c)


def floor_half_hour(c: Column | str) -> Column:
    """Start of the settlement period (half hour) containing ``c``."""
    c = col_of(c)
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(c) % 30, _seconds(c))


def floor_day(c: Column | str) -> Column:
    """Midnight (UTC) of the day containing ``c``, same type as ``c``."""
    c = col_of(c)
    return c - F.make_dt_interval(F.lit(0), F.hour(c), F.minute(c), _seconds(c))


def floor_millisecond(c: Column | str) -> Column:
    """Drop sub-millisecond digits (published timestamps are ms)."""
    c = col_of(c)
    micros = (_seconds(c) * 1_000_000) % 1000
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros / 1_000_000).cast("decimal(18,6)"))


def month_start(c: Column | str) -> Column:
    """First day of the month as DATE (the month partition key)."""
    return F.trunc(F.to_date(col_of(c)), "MM")


def day_date(c: Column | str) -> Column:
    return F.to_date(col_of(c))


def month_bounds(month: str) -> tuple[str, str]:
    """'YYYY-MM' or 'YYYY-MM-01' -> (first day, first day of next month) as text."""
    year, mon = int(month[:4]), int(month[5:7])
    nxt = (year + (mon == 12), 1 if mon == 12 else mon + 1)
    return f"{year:04d}-{mon:02d}-01", f"{nxt[0]:04d}-{nxt[1]:02d}-01"
