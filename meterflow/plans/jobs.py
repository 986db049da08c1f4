"""End-to-end jobs (JB1-JB5): raw files -> staging months -> published months.

Each job handles a *set* of months in one Spark job: files become input
partitions, the location lookup is joined without shuffling the readings,
one range shuffle orders the output, and dynamic partition overwrite
replaces only the months produced. Statistics are read back from what was
written (a cheap scan of two columns) instead of recomputing the inputs.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..functions.timefns import month_start
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import transform as T
from ..sinks import files as SINK
from ..sources import csvfiles as CSV
from ..sources import readers as R
from . import month_stats as MS

TS = "data_collection_log_timestamp"


def existing_paths(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Keep the glob patterns that match at least one file (missing days or
    months are skipped, not fatal)."""
    found = []
    for p in patterns:
        try:
            spark.read.text(p).schema  # lists the files only
            found.append(p)
        except AnalysisException:
            continue
    return found


@dataclass
class MonthBuild:
    months: list[str]
    stats: DataFrame | None
    outside: DataFrame | None = None


def _months_filter(col: str, months: list[str]):
    return F.col(col).isin([F.lit(m).cast("date") for m in months])


def build_ssen_months(
    spark: SparkSession,
    raw_dir: str,
    lookup: DataFrame,
    staging_root: str,
    months: list[str],
    min_partitions: int | None = None,
    check_lookup: bool = True,
) -> MonthBuild:
    """SSEN daily files of ``months`` -> located staging months (JB1).

    SC1 (+ SC13: absent days skipped), PR5 + JN2 + PR6 with the merged lookup
    (JN1), SO1 + SK1; AG1 stats per month by dataset id. ``check_lookup``
    first proves the lookup has one row per substation (EX2), since a repeated
    key would silently double readings.
    """
    if check_lookup:
        J.assert_unique(lookup, "substation_nrn")
    patterns = existing_paths(spark, [f"{raw_dir.rstrip('/')}/{m[:7]}-*.csv*" for m in months])
    if not patterns:
        return MonthBuild(months, None)
    readings = R.read_daily_readings(spark, patterns, min_partitions=min_partitions, with_file=True)
    located = J.attach_locations(readings, lookup)
    # the staging month is the file's month, as one month file holds its days' files
    staged = located.withColumn("month", C.month_from_ssen_url("source_file")).drop("source_file")
    SINK.write_staging(staged, staging_root, "SSEN")
    written = R.read_staging(spark, staging_root).where((F.col("dno") == "SSEN") & _months_filter("month", months))
    return MonthBuild(months, A.partition_stats(written, "SSEN", by=["month"]))


def build_nged_months(
    spark: SparkSession,
    raw_dir: str,
    staging_root: str,
    months: list[str],
    min_partitions: int | None = None,
    listed: list[str] | None = None,
    allow_missing: bool = False,
) -> MonthBuild:
    """NGED part files of ``months`` -> cleaned staging months (JB2).

    SC2 + PR2, PR3, PR4; FI3 keeps rows inside the month, SO1 + SK1. Parts are
    numbered from 0 without a gap, so a missing part is seen without a listing,
    save for the last ones: ``listed``, the file names the portal lists for these
    months, finds those, too. A missing part fails the build unless
    ``allow_missing``.

    The part files are parsed once. One write stages the rows of the month and,
    set aside, those of other months; its observed metrics count the latter. AG1 counts before the month filter (as published),
    so it reads both from what was written: two columns of Parquet.
    """
    parts = [f"{raw_dir.rstrip('/')}/aggregated-smart-meter-data-lv-feeder-{m[:7]}-part*.csv*" for m in months]
    patterns = existing_paths(spark, parts)
    if not allow_missing:
        absent = missing_parts(spark, raw_dir, patterns, listed or [])
        if absent:
            raise FileNotFoundError(f"parts that have not landed: {absent}")
    if not patterns:
        return MonthBuild(months, None)
    cleaned = T.clean_nged(R.read_part_readings(spark, patterns, min_partitions, with_file=True))
    cleaned = cleaned.withColumn("month", C.month_from_nged_url("source_file")).drop("source_file")
    inside = F.coalesce(month_start(TS) == F.col("month"), F.lit(False))
    seen = Observation()
    counts = [F.count_if(~inside & (F.col("month") == F.lit(m).cast("date"))).alias(m) for m in months]
    staged = cleaned.observe(seen, F.count(F.lit(1)).alias("n"), *counts).withColumn("outside", ~inside)
    SINK.write_staging(staged, staging_root, "NGED", aside="outside")
    outside = {m: seen.get[m] for m in months if seen.get[m]}
    built = (F.col("dno") == "NGED") & _months_filter("month", months)
    if outside:  # of months without such rows an earlier build's may lie there
        built = built | ((F.col("dno") == f"NGED{SINK.ASIDE_SUFFIX}") & _months_filter("month", list(outside)))
    written = spark.read.parquet(staging_root).where(built)
    report = spark.createDataFrame([(dt.date.fromisoformat(m), n) for m, n in outside.items()], "month date, rows_outside_month long")
    return MonthBuild(months, A.partition_stats(written, "NGED", by=["month"]), report)


def missing_parts(spark: SparkSession, raw_dir: str, patterns: list[str], listed: list[str]) -> list[str]:
    """Part files that should be there: those ``listed``, and those that the
    numbers of the landed ones skip."""
    landed = {f.rsplit("/", 1)[1] for f, _ in CSV.file_headers(spark, patterns)} if patterns else set()
    numbered: dict[str, dict[int, str]] = {}
    for name in landed:
        found = re.match(r"(.*-part)(\d{4})(\.csv.*)$", name)
        if found:
            numbered.setdefault(found[1], {})[int(found[2])] = found[3]
    gaps = [f"{stem}{i:04d}{next(iter(ends.values()))}" for stem, ends in numbered.items() for i in range(max(ends)) if i not in ends]
    return sorted(set(gaps) | (set(listed) - landed))


def combined_rows(spark: SparkSession, staging_root: str, months: list[str]) -> DataFrame:
    """Staging months of both DNOs -> published rows inside their month
    (SC6, PR11, PR13, PR14 per DNO, PR18, SE1, FI3)."""
    st = R.read_staging(spark, staging_root).where(_months_filter("month", months))
    # a reading counts in its own month's folder alone, whichever months are built together
    st = st.where(month_start(TS) == F.col("month"))
    parts = []
    for dno in S.PROCESSED_DNOS:
        part = st.where(F.col("dno") == dno)
        parts.append(T.to_published(part, dno))
    return parts[0].unionByName(parts[1])


def build_combined_months(
    spark: SparkSession,
    staging_root: str,
    published_root: str,
    months: list[str],
    geoparquet: bool = True,
    partitions: int | None = None,
) -> MonthBuild:
    """Published GeoParquet months (JB3): global order per month (SO2), AG1."""
    rows = combined_rows(spark, staging_root, months)
    SINK.write_published(rows, published_root, partitions=partitions, geoparquet=geoparquet)
    written = R.read_published(spark, published_root).where(_months_filter("month", months))
    return MonthBuild(months, A.partition_stats(written, "COMBINED", by=["month"]))


def ingest_raw(spark: SparkSession, path: str, dno: str, quarantine_dir: str | None = None, stats_root: str | None = None) -> dict[str, DataFrame]:
    """Validate and profile raw files (JB4): a file with any bad value is
    rejected whole (SK6); per-file row counts, distinct feeders (AG1) and the
    column profile (AG15). The files are parsed once; what follows reads the
    flagged copy. ``stats_root``: the good files' states for month statistics are
    kept there (``month_stats``), a rejected file's earlier one goes."""
    flagged, seen = Q.flag_once(R.raw_readings(spark, path, dno))
    good, bad = Q.split_by_file(flagged, seen["n_bad"])
    if quarantine_dir:
        bad.write.mode("overwrite").parquet(quarantine_dir)
    typed = R.canonical_columns(good, keep=["source_file"])
    key = A.feeder_key(dno)
    stats = typed.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("nunique_feeders"))
    if stats_root:
        name = C.filename_from_url("source_file")
        rows = good.withColumns({"file": name, "month": C.month_from_url("source_file", dno)})
        files = [r["f"] for r in flagged.select(name.alias("f")).distinct().collect()]  # a name per file of the batch
        MS.update_stats(spark, stats_root, rows, {"feeders": key}, files, file_col="file")
    return {"good": typed, "bad_files": bad, "stats": stats, "schema": A.schema_profile(spark, typed.drop("source_file"))}


def ingest_reference_data(mapping: DataFrame, model: DataFrame) -> dict[str, DataFrame]:
    """Profiles of the two reference inputs (JB5: AG2)."""
    return {"mapping": A.mapping_stats(mapping), "model": A.model_stats(model)}
