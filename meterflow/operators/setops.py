"""Set operations (SE1-SE5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def combine_dnos(frames: list[DataFrame | None]) -> DataFrame | None:
    """Concatenate the published rows of all DNOs; absent ones skipped (SE1)."""
    present = [f for f in frames if f is not None]
    if not present:
        return None
    return reduce(lambda a, b: a.unionByName(b), present)


def concat(frames: list[DataFrame]) -> DataFrame:
    """Concatenate extracts (SE2)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def intersect_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct ids in both (SE4)."""
    return a.intersect(b)


def union_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct ids in either (SE4)."""
    return a.union(b).distinct()


def difference_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids of ``a`` not in ``b`` (SE4)."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def distinct_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Distinct rows or first-per-subset (SE5)."""
    return df.dropDuplicates(subset) if subset else df.distinct()
