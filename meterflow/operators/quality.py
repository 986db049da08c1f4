"""Data-quality operators: bad-file quarantine (SK6), rows outside their
file's window (FI3 report, IN7) and insert lag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.timefns import month_start
from ..session import scratch_table

TS = "data_collection_log_timestamp"


def outside_range_report(df: DataFrame, start: str, end: str, by: list[str] | None = None, column: str = TS) -> DataFrame:
    """Rows a [start, end) window drops, counted per group and month, so the
    loss FI3 causes is visible instead of silent."""
    c = F.col(column)
    typ = df.schema[column].dataType.simpleString()
    inside = (c >= F.lit(start).cast(typ)) & (c < F.lit(end).cast(typ))
    out = df.where(~inside | c.isNull()).withColumn("month", month_start(column))
    return out.groupBy(*(by or []), "month").agg(F.count(F.lit(1)).alias("n_rows"))


def late_rows(df: DataFrame, file_month: str = "file_month", column: str = TS) -> DataFrame:
    """Rows whose reading month differs from the month of the file that
    carried them (IN7)."""
    return df.where(month_start(column) != F.col(file_month))


def insert_lag_profile(df: DataFrame, by: list[str] | None = None, exact: bool = False) -> DataFrame:
    """How long after the half hour a reading was inserted, in seconds (IN7):
    median, 90th percentile and maximum per group. ``exact`` uses the exact
    (linear-interpolated) percentile; the default approximate one keeps a
    bounded sketch per group."""
    by = by or []
    lag = F.timestamp_diff("SECOND", F.col(TS), F.col("insert_time")).cast("double")
    if exact:
        lags = df.select(*by, lag.alias("__lag"))
        out = exact_percentiles(lags, "__lag", {"lag_p50_s": 0.5, "lag_p90_s": 0.9}, by, maximum="lag_max_s")
        return out.select(*by, "lag_p50_s", "lag_p90_s", "lag_max_s")
    return df.groupBy(*by).agg(
        F.percentile_approx(lag, F.lit(0.5)).alias("lag_p50_s"),
        F.percentile_approx(lag, F.lit(0.9)).alias("lag_p90_s"),
        F.max(lag).alias("lag_max_s"),
    )


#: ranges a group's values are cut into, one below the other, to find a rank
RANGES = 256


def exact_percentiles(df: DataFrame, value: str, shares: dict[str, float], by: list[str], maximum: str | None = None) -> DataFrame:
    """Linear-interpolated percentiles per group, nulls left out: a row per group,
    a column per share (and one of the largest value).

    No task holds a group. Rows are counted per (group, value) first, map-side, so
    what goes on is distinct values. Each group's span is cut into ``RANGES`` equal
    ranges; their counts, summed up from below, give every value the number of
    values under its range, and a window inside one range of one group the rest.
    The values at the two ranks around a percentile are then picked by a plain
    aggregate. A group whose values sit close together beside far outliers has them
    in few ranges, whose windows then hold more distinct values, never rows.
    """
    if not by:
        one = df.withColumn("__one", F.lit(0))
        return exact_percentiles(one, value, shares, ["__one"], maximum).drop("__one")

    def same(a: DataFrame, b: DataFrame):
        cond = F.lit(True)
        for c in by:
            cond = cond & a[c].eqNullSafe(b[f"__{c}"])
        return cond

    def renamed(x: DataFrame) -> DataFrame:
        return x.withColumnsRenamed({c: f"__{c}" for c in by})

    v = F.col(value)
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    counts = scratch_table(counts, "value-counts")  # distinct values: read for the spans, the ranges and the ranks
    spans = counts.groupBy(*by).agg(F.min(value).alias("__low"), F.max(value).alias("__high"), F.sum(F.when(v.isNotNull(), F.col("__n"))).alias("__all"))
    known, right = counts.where(v.isNotNull()), renamed(spans)
    placed = known.join(right, same(known, right)).drop(*[f"__{c}" for c in by])
    width = (F.col("__high") - F.col("__low")) / RANGES
    cut = F.when(width > 0, F.least(F.floor((v - F.col("__low")) / width), F.lit(RANGES - 1))).otherwise(F.lit(0)).cast("int")
    placed = placed.withColumn("__range", cut)
    totals = placed.groupBy(*by, "__range").agg(F.sum("__n").alias("__sum"))
    upwards = Window.partitionBy(*by).orderBy("__range")  # RANGES rows at most
    under = totals.select(*by, "__range", (F.sum("__sum").over(upwards) - F.col("__sum")).alias("__under"))
    under = renamed(under).withColumnRenamed("__range", "__at")
    ranked = placed.join(under, same(placed, under) & (F.col("__range") == F.col("__at")))
    within = Window.partitionBy(*by, "__range").orderBy(value)
    last = F.col("__under") + F.sum("__n").over(within)  # how many values are not above this one
    ranked = ranked.select(*by, value, "__n", "__all", last.alias("__last"))
    aggs = []
    for name, share in shares.items():
        rank = F.lit(float(share)) * (F.col("__all") - 1)  # from 0, between two values
        for part, r in (("low", F.floor(rank)), ("high", F.ceil(rank))):
            holds = (F.col("__last") - F.col("__n") <= r) & (r < F.col("__last"))
            aggs.append(F.max(F.when(holds, v)).alias(f"__{name}_{part}"))
    picked = ranked.groupBy(*by).agg(F.max("__all").alias("__all"), F.max(value).alias("__most"), *aggs)
    out = [*[F.col(c) for c in by]]
    for name, share in shares.items():
        rank = F.lit(float(share)) * (F.col("__all") - 1)
        low, high = F.col(f"__{name}_low"), F.col(f"__{name}_high")
        out.append((low + (high - low) * (rank - F.floor(rank))).alias(name))
    if maximum:
        out.append(F.col("__most").alias(maximum))
    found = picked.select(*out)
    # groups of nulls alone have a row, too
    names = [*shares, *([maximum] if maximum else [])]
    groups = renamed(spans.select(*by))
    return groups.join(found, same(found, groups), "left").select(*[F.col(f"__{c}").alias(c) for c in by], *names)


def bad_value_flags(raw: DataFrame, timestamp_type: str = "timestamp") -> DataFrame:
    """Per raw row: does any typed column fail to convert? Text that is set
    but casts to null is a bad value."""
    bad = F.lit(False)
    for c in S.FLOAT_COLUMNS:
        bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast("double").isNull())
    for c in S.TIME_COLUMNS:
        bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast(timestamp_type).isNull())
    return raw.withColumn("__bad", bad)


def flag_once(raw_with_file: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The rows with their flag ``__bad``, written once to the shared folder, and
    what was counted on the way: n_rows, n_bad. All else (bad files, good rows,
    statistics) reads this copy, in columns; the raw files are parsed once."""
    seen = Observation()
    flagged = bad_value_flags(raw_with_file).observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if("__bad").alias("n_bad"))
    return scratch_table(flagged, "flagged-rows"), seen.get


def split_by_file(flagged: DataFrame, n_bad: int, file_col: str = "source_file") -> tuple[DataFrame, DataFrame]:
    """(rows of good files, bad files with their bad rows) of flagged rows."""
    bad_files = flagged.where("__bad").groupBy(file_col).agg(F.count(F.lit(1)).alias("bad_rows"))
    good = flagged.drop("__bad")
    if n_bad:  # one row per rejected file
        good = good.join(bad_files.select(file_col), file_col, "left_anti")
    return good, bad_files


def quarantine_bad_files(raw_with_file: DataFrame, file_col: str = "source_file") -> tuple[DataFrame, DataFrame]:
    """Split rows into (good rows, bad file list): one bad row rejects its whole
    file (SK6). The raw rows are read once."""
    flagged, seen = flag_once(raw_with_file)
    return split_by_file(flagged, seen["n_bad"], file_col)
