"""Aggregations (AG1-AG12, AG14, AG15).

Every aggregate is a ``groupBy().agg()`` so Spark combines map-side before
the shuffle; distinct counts go through Spark's expand-based two-phase plan,
which spreads a hot group's distinct values over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from . import ordering as O
from . import transform as T
from ..functions.timefns import floor_day, month_start

TS = "data_collection_log_timestamp"
CONSUMPTION = "total_consumption_active_import"
DEVICES = "aggregated_device_count_active"


def feeder_key(dno: str) -> Column:
    """The feeder identity used by a DNO's stats (AG1)."""
    key = dno.upper()
    if key == "SSEN":
        return F.col("dataset_id")
    if key == "NGED":
        return C.null_join("-", "secondary_substation_id", "lv_feeder_id")
    if key == "COMBINED":
        return F.col("lv_feeder_unique_id")
    raise ValueError(f"no feeder key is known for network operator {dno}")


def partition_stats(df: DataFrame, dno: str, by: list[str] | None = None, month_of: str = TS) -> DataFrame:
    """Rows and distinct feeders per month (null counts as one feeder, N6) (AG1).

    For the combined table the distinct substations are counted too.
    """
    by = by or ["month"]
    src = df.withColumn("month", month_start(month_of)) if "month" in by and "month" not in df.columns else df
    aggs = [
        F.count(F.lit(1)).alias("row_count"),
        C.count_distinct_with_null(feeder_key(dno)).alias("nunique_feeders"),
    ]
    if dno.upper() == "COMBINED":
        aggs.append(C.count_distinct_with_null("secondary_substation_unique_id").alias("nunique_substations"))
    return src.groupBy(*by).agg(*aggs)


def feed_stats(staged: DataFrame, month_of: str = TS) -> DataFrame:
    """``partition_stats`` of a staged feed of both networks and of the combined
    table made from it, in one pass: each row counts for its network and for the
    whole (dno, month, row_count, nunique_feeders, nunique_substations)."""
    none = F.lit(None).cast("string")
    ssen = F.col("dno_alias") == "SSEN"
    own = F.struct(
        F.when(ssen, F.lit("SSEN")).otherwise(F.lit("NGED")).alias("dno"),
        F.when(ssen, feeder_key("SSEN")).otherwise(feeder_key("NGED")).alias("feeder"), none.alias("station"),
    )
    whole = F.struct(F.lit("COMBINED").alias("dno"), feeder_key("COMBINED").alias("feeder"), F.col("secondary_substation_unique_id").alias("station"))
    rows = T.unique_ids(staged).select(month_start(month_of).alias("month"), F.explode(F.array(own, whole)).alias("r")).select("month", "r.*")
    stats = rows.groupBy("dno", "month").agg(
        F.count(F.lit(1)).alias("row_count"),
        C.count_distinct_with_null("feeder").cast("long").alias("nunique_feeders"),
        C.count_distinct_with_null("station").cast("long").alias("nunique_substations"),
    )
    return stats.withColumn("nunique_substations", F.when(F.col("dno") == "COMBINED", F.col("nunique_substations")))


def mapping_stats(mapping: DataFrame) -> DataFrame:
    """Rows, distinct feeder names, distinct postcodes (nulls ignored) (AG2)."""
    return mapping.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("lv_feeder_name").alias("nunique_feeders"),
        F.count_distinct("postcode").alias("nunique_postcodes"),
    )


def model_stats(model: DataFrame) -> DataFrame:
    """Rows, distinct reference numbers, rows lacking a coordinate (AG2)."""
    return model.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("full_nrn").alias("nunique_substations"),
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("number_of_na_locations"),
    )


def postcode_quality_stats(mapping_std: DataFrame, located_join: DataFrame) -> DataFrame:
    """Invalid postcodes (rows) and unmatched postcodes (distinct), one row per metric (AG4)."""
    from .filters import invalid_postcode_flag

    invalid = mapping_std.agg(F.count_if(invalid_postcode_flag()).alias("value")).select(
        F.lit("invalid_feeder_postcodes").alias("metric"), "value"
    )
    unmatched = located_join.agg(
        F.count_distinct(
            F.when(F.col("lat").isNull() | F.col("long").isNull(), F.col("standardised_postcode"))
        ).alias("value")
    ).select(F.lit("unmatched_feeder_postcodes").alias("metric"), "value")
    return invalid.unionByName(unmatched)


def consumption_by_substation(
    df: DataFrame, substation: str = "secondary_substation_unique_id", geometry: str = "geometry"
) -> DataFrame:
    """Sum of the numeric columns per (substation, location); rows with a null
    substation are dropped, as a pandas group-by does (AG5)."""
    return (
        df.where(F.col(substation).isNotNull())
        .groupBy(substation, geometry)
        .agg(F.sum(CONSUMPTION).alias(CONSUMPTION), F.sum(DEVICES).alias(DEVICES))
    )


def feeder_summary(df: DataFrame, feeder: str = "lv_feeder_unique_id") -> DataFrame:
    """Per feeder: count; min/max of timestamp, devices, consumption (AG6)."""
    return df.groupBy(feeder).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(TS).alias("first_ts"),
        F.max(TS).alias("last_ts"),
        F.min(DEVICES).alias("min_devices"),
        F.max(DEVICES).alias("max_devices"),
        F.min(CONSUMPTION).alias("min_consumption"),
        F.max(CONSUMPTION).alias("max_consumption"),
    )


def daily_consumption(df: DataFrame, feeder: str, value: str, ts: str = TS, materialize: bool = True) -> DataFrame:
    """Half hours resampled to UTC days per feeder; every day between the
    overall first and last day appears, empty days as 0 (AG7).

    The per-(feeder, day) sums are the only data the rest needs, and they are
    small (feeders x days). With ``materialize`` they are written once as a
    table in the shared checkpoint folder (``spark.checkpoint.dir``) and read
    back, so the input pipeline runs exactly once; the bounds (scalar
    subqueries), the feeder list and the zero spine all come from the sums. The spine is
    built per feeder by ``explode(sequence())`` and merged by a union and
    re-aggregation instead of a join.
    """
    day = floor_day(ts)
    sums = df.groupBy(F.col(feeder).alias(feeder), day.alias("day")).agg(F.sum(value).alias(value))
    if materialize:
        from ..session import scratch_table

        sums = scratch_table(sums, "daily-sums")
    # bounds as scalar subqueries over the sums: typed like the column (a naive
    # timestamp stays naive), no driver round trip
    lo = sums.select(F.min("day")).scalar()
    hi = sums.select(F.max("day")).scalar()
    spine = sums.select(feeder).distinct().select(
        feeder,
        F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("day"),
        F.lit(0).cast(sums.schema[value].dataType).alias(value),
    )
    return sums.unionByName(spine).groupBy(feeder, "day").agg(F.sum(value).alias(value))


def pivot_feeders(df: DataFrame, index: list[str], column: str, values: list[str] | None, value: str, max_width: int = 1000) -> DataFrame:
    """Index x feeder matrix over the feeders of ``values`` (AG8). Without
    ``values``: over all feeders present, at most ``max_width`` of them. A
    feeder outside the list is an error: no row vanishes.

    A second value for one cell is an error, as in a pandas pivot. One
    aggregation computes the cells and the duplicate check together.
    """
    if values is None:
        found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_width + 1).collect()
        if len(found) > max_width:
            raise ValueError(f"more than {max_width} values of {column}")
        values = sorted(r[0] for r in found)
    if not values:
        return df.select(*index).distinct()
    other = F.count(F.when(~F.col(column).isin(values), F.lit(1))) > 0
    aggs = []
    for v in values:
        hit = F.col(column) == F.lit(v)
        aggs.append(
            F.when(other, F.raise_error(F.lit(f"{column} outside the list")))
            .when(F.count(F.when(hit, F.lit(1))) > 1, F.raise_error(F.lit(f"duplicate cell for {column}={v}")))
            .otherwise(F.max(F.when(hit, F.col(value))))
            .alias(f"{column}_{v}")
        )
    return df.groupBy(*index).agg(*aggs)


def pivot_blocks(df: DataFrame, index: list[str], column: str, value: str, width: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Index x feeder matrix over all feeders present, however many (AG8).

    Feeders get numbers in their order; ``width`` of them make a block of columns.
    Returns the matrix in blocks (index, block, cells: a map from the place in the
    block to the value, missing cells left out) and the columns (column, block,
    place). The number of feeders is in the data alone: no list of them comes to
    the driver, no expression is made for each, and a row holds ``width`` cells at
    most. A second value for one cell is an error; null feeders have no column and
    null values no cell.
    """
    ids = O.numbered(df.where(F.col(column).isNotNull()).select(column).distinct(), [column], "__nr")
    columns = ids.select(column, F.floor(F.col("__nr") / width).alias("block"), (F.col("__nr") % width).cast("int").alias("place"))
    # combined map-side: repetitions of a cell meet as a count, not as rows
    cells = df.where(F.col(column).isNotNull()).groupBy(*index, column).agg(F.count(F.lit(1)).alias("__n"), F.max(value).alias("__value"))
    once = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit(f"duplicate cell for {column}="), F.col(column).cast("string"))).cast(df.schema[value].dataType)).otherwise(F.col("__value"))
    placed = cells.withColumn("__value", once).where(F.col("__value").isNotNull()).join(columns, column)
    return placed.groupBy(*index, "block").agg(F.map_from_entries(F.collect_list(F.struct("place", "__value"))).alias("cells")), columns


def unpivot_blocks(blocks: DataFrame, columns: DataFrame, index: list[str], column: str, value: str) -> DataFrame:
    """The long form of ``pivot_blocks``: index, column, value."""
    cells = blocks.select(*index, "block", F.explode("cells").alias("place", value))
    return cells.join(columns, ["block", "place"]).select(*index, column, value)


def readings_per_feeder(df: DataFrame, feeder: str = "lv_feeder_unique_id") -> DataFrame:
    """Distinct timestamps per feeder, most first (AG9)."""
    return df.groupBy(feeder).agg(F.count_distinct(TS).alias("n_timestamps"))


def expected_readings(df: DataFrame) -> DataFrame:
    """(last - first) / 30 min over the whole frame (AG10)."""
    return df.agg(
        (F.timestamp_diff("SECOND", F.min(TS), F.max(TS)) / F.lit(1800.0)).alias("expected_readings")
    )


def null_audit(df: DataFrame, by: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows and non-null count per column, optionally per group (AG12)."""
    columns = columns or [c for c in df.columns if c not in (by or [])]
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [F.count(F.col(c)).alias(f"nonnull_{c}") for c in columns]
    return df.groupBy(*(by or [])).agg(*aggs)


def day_comparison(df: DataFrame, day1: str, day2: str, feeder: str = "dataset_id", columns: list[str] | None = None) -> DataFrame:
    """Per day (of the two): rows, non-null per column, distinct timestamps
    and feeders (AG11)."""
    day = F.to_date(F.col(TS))
    two = df.where(day.isin(F.lit(day1).cast("date"), F.lit(day2).cast("date"))).withColumn("day", day)
    cols = columns or [c for c in df.columns]
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_distinct(TS).alias("n_timestamps"), F.count_distinct(feeder).alias("n_feeders")]
    aggs += [F.count(F.col(c)).alias(f"nonnull_{c}") for c in cols]
    return two.groupBy("day").agg(*aggs)


def vanished_feeders(df: DataFrame, day1: str, day2: str, feeder: str = "dataset_id") -> DataFrame:
    """Feeders present on ``day1`` and absent on ``day2`` (AG11)."""
    day = F.to_date(F.col(TS))
    a = df.where(day == F.lit(day1).cast("date")).select(feeder).distinct()
    b = df.where(day == F.lit(day2).cast("date")).select(feeder).distinct()
    return a.join(b, feeder, "left_anti")


def latest_file(manifest: DataFrame) -> DataFrame:
    """Newest created time and last file name (AG14)."""
    return manifest.agg(F.max("created").alias("max_created"), F.max("filename").alias("max_filename"))


def schema_profile(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column names and types, as stored with each output (AG15)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, nullable boolean")

