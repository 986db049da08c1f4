"""Sorts, samples and top-n (SO1-SO5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import scratch_table


def nulls_last(cols: list[str]):
    return [F.col(c).asc_nulls_last() for c in cols]


def staging_order(df: DataFrame) -> DataFrame:
    """Global (timestamp, alias, substation, feeder) order, nulls last (SO1)."""
    return df.orderBy(*nulls_last(S.STAGING_SORT))


def published_order(df: DataFrame) -> DataFrame:
    """Global (timestamp, alias, substation id, feeder id) order (SO2)."""
    return df.orderBy(*nulls_last(S.PUBLISHED_SORT))


def range_sorted_for_write(df: DataFrame, sort_cols: list[str], partition_col: str | None = "month", n: int | None = None) -> DataFrame:
    """Range-partition by (month, sort keys) and sort inside each partition.

    Partitioning by month alone would put a whole (possibly hot) month in one
    task; adding the timestamp to the range key splits every month across as
    many tasks as its size needs, and the file names follow the order.
    """
    keys = ([partition_col] if partition_col else []) + sort_cols
    parted = df.repartitionByRange(n, *nulls_last(keys)) if n else df.repartitionByRange(*nulls_last(keys))
    return parted.sortWithinPartitions(*nulls_last(keys))


#: cells a side of the grid over the globe by which published files are clustered
GRID_BITS = 14


def z_cell(geometry: str = "geometry", bits: int = GRID_BITS) -> Column:
    """The place of a lon/lat point's grid cell along a Z-order curve: cells near
    each other on the map are mostly near along it. -1 without a location."""
    cells = float(1 << bits)

    def axis(c: str, low: float, span: float) -> Column:
        return F.least(F.greatest(F.floor((F.col(f"{geometry}.{c}") - low) / span * cells), F.lit(0)), F.lit((1 << bits) - 1))

    x, y = axis("x", -180.0, 360.0), axis("y", -90.0, 180.0)
    code = F.lit(0).cast("long")
    for b in range(bits):
        code = code + F.shiftright(x, b).bitwiseAND(F.lit(1)) * (1 << (2 * b)) + F.shiftright(y, b).bitwiseAND(F.lit(1)) * (1 << (2 * b + 1))
    known = F.col(f"{geometry}.x").isNotNull() & ~F.isnan(f"{geometry}.x") & F.col(f"{geometry}.y").isNotNull() & ~F.isnan(f"{geometry}.y")
    return F.when(known, code).otherwise(F.lit(-1).cast("long"))


def space_sorted_for_write(df: DataFrame, sort_cols: list[str], partition_col: str = "month", n: int | None = None) -> DataFrame:
    """Files of neighbouring places, each sorted by ``sort_cols``: range-partitioned
    by (month, Z-order cell, sort keys), so that a busy cell is split, too. A box
    then meets few files, and a time range few row groups of each."""
    keyed = df.withColumn("__cell", z_cell())
    keys = nulls_last([partition_col, "__cell", *sort_cols])
    parted = keyed.repartitionByRange(n, *keys) if n else keyed.repartitionByRange(*keys)
    return parted.sortWithinPartitions(*nulls_last([partition_col, *sort_cols])).drop("__cell")


def day_sorted_for_write(df: DataFrame, sort_cols: list[str], ts: str = "data_collection_log_timestamp", partition_col: str = "month", folders: list[str] | None = None) -> DataFrame:
    """One pass: rebalance by (month, day) and sort inside each partition.

    Every file is sorted and holds whole days (a hot day is split by AQE's
    rebalance, small days are coalesced), which is what row-group pruning
    needs; unlike a range exchange it needs no sampling job, so the upstream
    (e.g. parsing raw CSVs) runs once. ``folders``: partition columns that stand
    before ``partition_col`` in the paths written.
    """
    day = F.to_date(F.col(ts))
    keyed = df.withColumn("__day", day)
    return keyed.hint("rebalance", partition_col, "__day").sortWithinPartitions(*nulls_last([*(folders or []), partition_col, *sort_cols])).drop("__day")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with the place of each row in ``order``, from 0, without sorting in
    one task: rows are sorted in ranges, written once, and each range's numbers
    start where the one before ends. A count per range comes to the driver."""
    keys = nulls_last(order)
    ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    low = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the row's place in its task
    kept = scratch_table(ranges.withColumns({"__range": F.spark_partition_id(), "__place": low}), "numbered")
    starts, total = [], 0
    for r in kept.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).orderBy("__range").collect():
        starts.append((r["__range"], total))
        total += r["n"]
    first = df.sparkSession.createDataFrame(starts, "__range int, __first long")
    return kept.join(first, "__range").withColumn(name, F.col("__first") + F.col("__place")).drop("__range", "__place", "__first")


def extract_order(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Sort an extract by timestamp then feeder (SO3)."""
    return df.orderBy(*nulls_last(cols or ["data_collection_log_timestamp", "lv_feeder_unique_id"]))


def sample_ids(df: DataFrame, column: str, n: int, seed: int = 0, by: str | None = None) -> DataFrame:
    """A repeatable random ``n`` of the distinct non-null ids, sorted (SO4); with
    ``by``, of the ids of each group (a region), groups first.

    The ids with the ``n`` smallest hashes (md5 of id and seed, so that any
    engine can repeat it) are the sample. Ids are made distinct map-side; of what
    is left each task keeps the ``n`` smallest, of each group, before the final
    merge: a group's whole ids meet in no task.
    """
    keys = [by] if by else []
    ids = df.where(F.col(column).isNotNull()).select(*keys, column).distinct()
    draw = [F.md5(F.concat(F.col(column).cast("string"), F.lit(f"#{seed}")).cast("binary")), F.col(column)]
    if not by:
        return ids.orderBy(*draw).limit(n).orderBy(column)
    ranked = ids.withColumn("__rank", F.row_number().over(Window.partitionBy(by).orderBy(*draw))).where(F.col("__rank") <= n)
    return ranked.drop("__rank").orderBy(by, column)


def top_n(df: DataFrame, by: str, n: int, tie_break: list[str] | None = None) -> DataFrame:
    """The ``n`` largest by ``by`` with a fixed tie-break (SO5)."""
    return df.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in (tie_break or [])]).limit(n)
