"""Readers for the raw and staged files (SC1-SC8).

CSV files are read with every column as text, by each file's own header
(``csvfiles``), and cast by name afterwards. Gzip files are not splittable, so a read of few large files can be spread
into ``min_partitions`` partitions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from . import csvfiles as CSV


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def canonical_columns(
    df: DataFrame, timestamp_type: str = "timestamp", safe: bool = False, keep: list[str] | None = None
) -> DataFrame:
    """Keep the 12 staging columns, typed (PR1, rule N1).

    Text blanks stay '' (a CSV read gives null for them); numbers and
    timestamps are cast, failing on bad text unless ``safe`` (then null).
    ``keep`` names extra columns carried through unchanged.
    """
    require_columns(df, S.CANONICAL_COLUMNS, "readings")
    cast = (lambda c, t: c.try_cast(t)) if safe else (lambda c, t: c.cast(t))
    cols: list[Column] = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in S.TEXT_COLUMNS]
    cols += [cast(F.col(c), "double").alias(c) for c in S.FLOAT_COLUMNS]
    cols += [cast(F.col(c), timestamp_type).alias(c) for c in S.TIME_COLUMNS]
    cols += [F.col(c) for c in (keep or [])]
    return df.select(cols)


def rename_nged(df: DataFrame) -> DataFrame:
    """NGED header spellings -> staging names (PR2)."""
    present = {k: v for k, v in S.NGED_RENAMES.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions) if partitions else df


def raw_readings(spark: SparkSession, path: str | list[str], dno: str) -> DataFrame:
    """The 12 staging columns as text, and ``source_file``: columns are picked by
    name from each file's own header, NGED spellings renamed (PR2)."""
    renames = S.NGED_RENAMES if dno.upper() == "NGED" else None
    return CSV.read_csv(spark, path, S.CANONICAL_COLUMNS, renames=renames)


def _readings(spark, path, dno, min_partitions, with_file) -> DataFrame:
    typed = canonical_columns(raw_readings(spark, path, dno), keep=["source_file"] if with_file else None)
    return _spread(typed, min_partitions)


def read_daily_readings(
    spark: SparkSession, path: str | list[str], min_partitions: int | None = None, with_file: bool = False
) -> DataFrame:
    """SSEN daily files (gzip CSV) -> staging columns (SC1)."""
    return _readings(spark, path, "SSEN", min_partitions, with_file)


def read_part_readings(
    spark: SparkSession, path: str | list[str], min_partitions: int | None = None, with_file: bool = False
) -> DataFrame:
    """NGED monthly part files -> staging columns after the header renames (SC2)."""
    return _readings(spark, path, "NGED", min_partitions, with_file)


def read_postcode_mapping(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Feeder -> postcode mapping, all text (SC3)."""
    df = CSV.read_csv(spark, path).drop("source_file")
    require_columns(df, ["dataset_id", "postcode"], "postcode mapping")
    return df


def _null_sentinel(c: Column, sentinel: str) -> Column:
    text = F.trim(c)
    value = text.try_cast("double")
    return F.when(text.isNull() | (text == sentinel) | (value == float(sentinel)), F.lit(None).cast("double")).otherwise(
        text.cast("double")
    )


def postcode_directory_from_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Typed directory from its text form: lat/long with per-column sentinels (N8)."""
    keep = cols or df.columns
    out = df.select(*keep)
    if "lat" in keep:
        out = out.withColumn("lat", _null_sentinel(F.col("lat"), S.POSTCODE_NULL_LAT))
    if "long" in keep:
        out = out.withColumn("long", _null_sentinel(F.col("long"), S.POSTCODE_NULL_LONG))
    return out


def read_postcode_directory(spark: SparkSession, folder: str, cols: list[str] | None = None) -> DataFrame:
    """The postcode directory CSV inside an extracted archive folder (SC4)."""
    df = CSV.read_csv(spark, folder, cols, glob="*.[cC][sS][vV]", name_pattern=S.POSTCODE_FILE_PATTERN)
    return postcode_directory_from_text(df.drop("source_file"), cols)


def model_from_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    keep = cols or df.columns
    out = df.select(*keep)
    for c in ("latitude", "longitude"):
        if c in keep:
            out = out.withColumn(c, F.trim(F.col(c)).cast("double"))
    return out


def read_transformer_model(spark: SparkSession, path: str | list[str], cols: list[str] | None = None) -> DataFrame:
    """Transformer load model: full_nrn text, latitude/longitude doubles (SC5).

    A ``file_row`` column keeps the file order for first-row de-duplication.
    """
    df = CSV.read_csv(spark, path, cols, position=True).drop("source_file")
    return model_from_text(df, (cols + ["file_row"]) if cols else None)


def read_staging(spark: SparkSession, root: str) -> DataFrame:
    """All staging months: ``root/dno=<DNO>/month=<YYYY-MM-01>/``, without the
    rows set aside."""
    from ..sinks.files import ASIDE_SUFFIX

    return spark.read.parquet(root).where(~F.col("dno").endswith(ASIDE_SUFFIX))


def read_staging_month(spark: SparkSession, root: str, dno: str, month: str) -> DataFrame:
    """One DNO month with the timestamp range pushed to the row groups (SC6)."""
    from ..functions.timefns import month_bounds

    start, end = month_bounds(month)
    ts = F.col("data_collection_log_timestamp")
    return (
        read_staging(spark, root)
        .where((F.col("dno") == dno.upper()) & (F.col("month") == F.lit(start).cast("date")))
        .where((ts >= F.lit(start).cast("timestamp")) & (ts < F.lit(end).cast("timestamp")))
        .drop("dno", "month")
    )


def read_location_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Lookup table (substation_nrn, substation_geo_location) (SC8)."""
    return spark.read.parquet(path).select(*S.LOOKUP_COLUMNS)


def published_files(spark: SparkSession, root: str) -> DataFrame:
    """The data files of a published table: a row per file with its month, rows,
    bounding box and time range, as the newest index file of each month has them."""
    from ..sinks.geoparquet import INDEX_SCHEMA

    lines = spark.read.schema(INDEX_SCHEMA).json(f"{root.rstrip('/')}/index").withColumn("version", F.col("_metadata.file_name"))
    newest = lines.groupBy("month").agg(F.max("version").alias("version"))
    return lines.join(newest, ["month", "version"]).drop("version")


def has_index(spark: SparkSession, root: str) -> bool:
    try:
        spark.read.schema("file string").json(f"{root.rstrip('/')}/index")
    except AnalysisException:
        return False
    return True


def read_published(spark: SparkSession, root: str, files: Column | None = None) -> DataFrame:
    """The published table. With an index (GeoParquet), the files it names;
    ``files``, a predicate over ``published_files``, leaves out the others. A
    table that Spark's own writer made is read as a folder."""
    if not has_index(spark, root):
        return spark.read.parquet(root)
    listed = published_files(spark, root)
    everything = [f"{root.rstrip('/')}/files/{r['file']}" for r in (listed if files is None else listed.where(files)).select("file").orderBy("file").collect()]
    none = not everything
    if none:  # no file can hold such a row: the schema of any
        everything = [f"{root.rstrip('/')}/files/{r['file']}" for r in listed.select("file").limit(1).collect()]
    out = spark.read.option("basePath", f"{root.rstrip('/')}/files").parquet(*everything).drop("job")
    return out.limit(0) if none else out


def read_readings(
    spark: SparkSession,
    root: str,
    columns: list[str] | None = None,
    filters: list | None = None,
    bbox: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Query-side read of the published table (SC7).

    ``filters`` uses the DNF predicate form of FI5; a timestamp range in it
    is also turned into a ``month`` folder predicate so whole months are
    skipped before any footer is opened. ``bbox`` leaves out the files whose
    box it does not meet (none has a location inside it), then the row groups
    and the rows.
    """
    from ..operators.filters import bbox_filter, dnf_filter, month_predicate_from_filters

    month_pred = month_predicate_from_filters(filters) if filters else None
    wanted = month_pred
    if bbox:
        x0, y0, x1, y1 = bbox
        meets = (F.col("x_min") <= x1) & (F.col("x_max") >= x0) & (F.col("y_min") <= y1) & (F.col("y_max") >= y0)
        wanted = meets if wanted is None else wanted & meets
    df = read_published(spark, root, wanted)
    if filters:
        if month_pred is not None and "month" in df.columns:
            df = df.where(month_pred)
        df = dnf_filter(df, filters)
    if bbox:
        df = bbox_filter(df, *bbox)
    if columns:
        df = df.select(*columns)
    return df
