"""Query-side jobs on the published table (JB6-JB8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import aggregates as A
from ..operators import filters as FI
from ..operators import ordering as O
from ..operators import transform as T
from ..operators import windows as W

TS = "data_collection_log_timestamp"
CONSUMPTION = "total_consumption_active_import"


def consumption_map(
    readings: DataFrame,
    period=None,
    bbox: tuple[float, float, float, float] | None = None,
    per_period: bool = False,
) -> DataFrame:
    """kWh per substation (and location) over the half hours of ``readings``
    together (one half hour: ``period``, or readings of one), or at every half
    hour with ``per_period`` (JB6: FI4, FI6, AG5, FI8, PR19).

    The outlier cut applies to the substation sum of a half hour, as the maps
    do: its limit means nothing to a sum over months.
    """
    df = readings
    if period is not None:
        df = FI.settlement_period(df, period)
    if bbox is not None:
        df = FI.bbox_filter(df, *bbox)
    sub = "secondary_substation_unique_id"
    summed = (
        df.where(F.col(sub).isNotNull())
        .groupBy(TS, sub, "geometry")
        .agg(F.sum(CONSUMPTION).alias(CONSUMPTION), F.sum("aggregated_device_count_active").alias("aggregated_device_count_active"))
    )
    kept = FI.drop_outliers(summed, CONSUMPTION, S.OUTLIER_WH)
    return T.with_kwh(kept if per_period else A.consumption_by_substation(kept))


def feeder_timeseries(
    readings: DataFrame, filters=None, dedupe: bool = True, daily: bool = True, exact: bool = False
) -> DataFrame:
    """Per-device kWh per feeder, resampled to days (JB7: FI5, WN1, FI8,
    PR19, PR20, AG7). The v1.0 order: de-duplicate, drop outliers, convert.

    ``exact`` sums in DECIMAL(38,12) so daily totals do not depend on the
    order in which a distributed sum adds the half hours."""
    df = readings
    if filters:
        df = FI.dnf_filter(df, filters)
    if dedupe:
        df = W.dedupe_readings(df)
    df = FI.drop_outliers(df)
    df = T.with_normalised(T.with_kwh(df))
    if exact:
        df = df.withColumn("normalised_consumption", F.col("normalised_consumption").cast("decimal(38,12)"))
    if not daily:
        return df.select(TS, "lv_feeder_unique_id", "normalised_consumption")
    return A.daily_consumption(df, "lv_feeder_unique_id", "normalised_consumption")


EXTRACT_COLUMNS = [
    TS,
    "secondary_substation_unique_id",
    "lv_feeder_unique_id",
    "latitude",
    "longitude",
    "aggregated_device_count_active",
    CONSUMPTION,
]


def feeder_extract(readings: DataFrame, n: int, seed: int, bbox=None, by: str | None = None) -> DataFrame:
    """All rows of a seeded random sample of ``n`` feeders (of each group ``by``),
    sorted, with latitude/longitude columns (JB8: SO4, FI7, PR17, SO3, PR21)."""
    area = FI.bbox_filter(readings, *bbox) if bbox else readings
    sample = O.sample_ids(area, "lv_feeder_unique_id", n, seed, by).select("lv_feeder_unique_id")
    picked = FI.in_list(readings, "lv_feeder_unique_id", sample)
    flat = T.flatten_geometry(picked)
    return O.extract_order(flat.select(*EXTRACT_COLUMNS))
