"""Window operators (WN1-WN4).

Each window is partitioned by a feeder/substation key (never an unpartitioned
window), so rows are spread over tasks by that key. A deduplication key
that may be hot is handled by ``dedupe_readings`` through an aggregate
(``min`` of a struct) instead of a window: Spark combines it map-side,
so a key holding a third of the rows is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TS = "data_collection_log_timestamp"


def first_by(df: DataFrame, keys: list[str], order: list[str], nulls_first_flags: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (nulls last), ties
    broken by the remaining columns (nulls last), so the pick is exact.

    One ``min`` over a struct of all columns, each behind its null flag, in an
    aggregate: Spark reduces each key map-side before the shuffle, so a key
    holding a third of all rows never lands whole in one task (a window would
    sort it in one task). ``nulls_first_flags`` names columns whose rows with
    nulls rank after rows where they are all set (checked before ``order``).
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    fields = []
    if nulls_first_flags:
        missing = None
        for c in nulls_first_flags:
            m = F.col(c).isNull()
            missing = m if missing is None else (missing | m)
        fields.append(missing.alias("__missing"))
    ranked = [c for c in order if c in others]
    for c in ranked + [c for c in others if c not in order]:
        fields += [F.col(c).isNull().alias(f"__n_{c}"), F.col(c).alias(f"__v_{c}")]
    least = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("__least"))
    return least.select(*[F.col(c) if c in keys else F.col("__least")[f"__v_{c}"].alias(c) for c in df.columns])


def dedupe_readings(
    df: DataFrame,
    keys: list[str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Keep one row per (timestamp, feeder): the clock-change duplicates (WN1).

    "First" has no meaning in a distributed table, so the kept row is the
    smallest by ``order`` (default dataset id, consumption, devices) with
    nulls last; ties beyond that keep the smallest full row.
    """
    keys = keys or [TS, "lv_feeder_unique_id"]
    order = order or ["dataset_id", "total_consumption_active_import", "aggregated_device_count_active"]
    return first_by(df, keys, order)


def first_per_key(df: DataFrame, key: str, order: list[str], prefer_non_null: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the first by ``order``; with ``prefer_non_null``
    rows whose named columns are all set come first (WN2 default, EX3)."""
    return first_by(df, [key], order, prefer_non_null)


def dedupe_model(df: DataFrame, strict: bool = False, order: str = "file_row") -> DataFrame:
    """First model row per full_nrn (WN2). ``strict`` copies file-order
    semantics exactly (a null first row then loses the substation later)."""
    prefer = None if strict else ["latitude", "longitude"]
    return first_per_key(df, "full_nrn", [order], prefer)


def new_missing_by_month(df: DataFrame, key: str = "secondary_substation_id", month: str = "month") -> DataFrame:
    """Substations whose missing data shows first in each month (WN3):
    the month equals the substation's earliest month with missing data."""
    w = Window.partitionBy(key)
    pairs = df.select(key, month).distinct()
    return pairs.withColumn("__first", F.min(month).over(w)).where(F.col(month) == F.col("__first")).drop("__first")


def gap_intervals(df: DataFrame, feeder: str = "lv_feeder_unique_id", step_seconds: int = 1800) -> DataFrame:
    """Missing stretches per feeder: consecutive readings more than one
    settlement period apart give (gap_start, gap_end, missing periods) (WN4)."""
    ts = F.col(TS)
    pts = df.select(feeder, TS).distinct()
    w = Window.partitionBy(feeder).orderBy(TS)
    prev = F.lag(ts).over(w)
    with_prev = pts.withColumn("__prev", prev)
    diff = F.timestamp_diff("SECOND", F.col("__prev"), ts)
    return with_prev.where(diff > step_seconds).select(
        feeder,
        F.col("__prev").alias("gap_after"),
        ts.alias("gap_before"),
        (diff / step_seconds - 1).cast("long").alias("missing_periods"),
    )
