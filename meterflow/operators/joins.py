"""Equi-joins of readings, lookups, mappings and manifests (JN1-JN4, JN6-JN8).

Broadcasts are size-checked: a side is broadcast only after a bounded count
proves it small; otherwise the join shuffles and AQE may still switch it at
run time. Skewed keys on the large side are split by AQE's skew-join rule
(enabled in the session settings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import substation_nrn_from_dataset

def merged_location_lookup(postcode_lookup: DataFrame, model_lookup: DataFrame) -> DataFrame:
    """Every substation of either lookup; the model location wins, the
    postcode one fills in (JN1: full outer join + coalesce).

    Written as a union and one aggregate: ``min_by(location, rank)`` with a
    non-null model location first, then a non-null postcode location, else
    null. Same result as the full outer join with one shuffle (combined
    map-side) instead of two shuffles and two sorts. Each lookup has one row
    per key.
    """
    loc = F.col("substation_geo_location")

    def ranked(df: DataFrame, rank: int) -> DataFrame:
        return df.select("substation_nrn", loc, F.when(loc.isNull(), F.lit(3)).otherwise(F.lit(rank)).alias("__rank"))

    both = ranked(model_lookup, 1).unionByName(ranked(postcode_lookup, 2))
    return both.groupBy("substation_nrn").agg(F.min_by(loc, F.col("__rank")).alias("substation_geo_location"))


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """Fail at run time if ``key`` repeats (guards JN2 against doubled rows)."""
    dup = df.groupBy(key).count().where(F.col("count") > 1)
    if dup.limit(1).count():
        raise ValueError(f"lookup key {key} is not unique")
    return df


def attach_locations(readings: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join readings to the lookup on the 10-character prefix; the
    looked-up location replaces the file's, unmatched rows get null (JN2, PR5, PR6).

    The lookup has one row per substation (about 1e5 rows), so it is small:
    by default the planner's own size checks pick the broadcast (the static
    ``autoBroadcastJoinThreshold`` for a lookup read from files, AQE's
    run-time shuffle statistics for a derived one) and the readings are
    never shuffled.
    """
    lk = lookup.select(
        F.col("substation_nrn").alias("__nrn"), F.col("substation_geo_location").alias("__loc")
    )
    cols = [c for c in readings.columns]
    joined = readings.join(lk, substation_nrn_from_dataset("dataset_id") == F.col("__nrn"), "left")
    return joined.select(*[F.col("__loc").alias(c) if c == "substation_geo_location" else F.col(c) for c in cols])


def locate_postcodes(mapping: DataFrame, directory: DataFrame, key: str = "standardised_postcode") -> DataFrame:
    """Left equi-join of feeder postcodes to the directory (JN3)."""
    return mapping.join(directory, key, "left")


def match_substations(nrns: DataFrame, model: DataFrame, key: str = "substation_nrn") -> DataFrame:
    """Distinct substations inner-joined to the model by reference number (JN4)."""
    return nrns.select(key).distinct().join(model, key, "inner")


def coverage_sets(all_ids: DataFrame, a: DataFrame, b: DataFrame, key: str = "substation_nrn") -> DataFrame:
    """Per id: located by A, by B; one row per id of the union (JN6)."""
    base = all_ids.select(key).distinct().withColumn("__in_all", F.lit(True))
    ia = a.select(key).distinct().withColumn("in_a", F.lit(True))
    ib = b.select(key).distinct().withColumn("in_b", F.lit(True))
    j = base.join(ia, key, "full").join(ib, key, "full")
    return j.select(
        key,
        F.coalesce(F.col("__in_all"), F.lit(False)).alias("in_all"),
        F.coalesce(F.col("in_a"), F.lit(False)).alias("in_a"),
        F.coalesce(F.col("in_b"), F.lit(False)).alias("in_b"),
    )


def coverage_summary(flags: DataFrame) -> DataFrame:
    """Counts of ids located by A, B, both, neither, A only, B only (JN6)."""
    a, b = F.col("in_a"), F.col("in_b")
    return flags.agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.count_if(a).alias("n_a"),
        F.count_if(b).alias("n_b"),
        F.count_if(a & b).alias("n_both"),
        F.count_if(~a & ~b).alias("n_neither"),
        F.count_if(a & ~b).alias("n_a_only"),
        F.count_if(~a & b).alias("n_b_only"),
    )


def backfill_candidates(
    readings: DataFrame,
    missing: DataFrame,
    key: str = "secondary_substation_id",
    order: list[str] | None = None,
) -> DataFrame:
    """For each substation with missing ids, its first row (by month, then
    ``order``) that does carry a dataset id (JN7)."""
    from .windows import first_by

    order = order or ["data_collection_log_timestamp", "lv_feeder_id"]
    have = readings.where(F.col("dataset_id").isNotNull() & (F.col("dataset_id") != ""))
    cand = have.join(missing.select(key).distinct(), key, "left_semi")
    return first_by(cand, [key], order)


def unseen_files(manifest: DataFrame, ingested: DataFrame, key: str = "filename") -> DataFrame:
    """Listed files whose name was not ingested yet (JN8)."""
    return manifest.join(ingested.select(key).distinct(), key, "left_anti")
