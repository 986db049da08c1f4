"""DataFrame-level column rules: staging clean-up and the published form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..functions.timefns import floor_millisecond


def blank_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NGED "no value" tokens -> null in the five text columns (PR3)."""
    return df.withColumns({c: C.blank_to_null(c) for c in (cols or S.NGED_BLANK_COLUMNS)})


def fill_dno_alias(df: DataFrame, alias: str = S.NGED_DEFAULT_ALIAS) -> DataFrame:
    """Null alias -> constant (PR4)."""
    return df.withColumn("dno_alias", F.coalesce(F.col("dno_alias"), F.lit(alias)))


def clean_nged(df: DataFrame) -> DataFrame:
    """PR3 then PR4, the NGED staging clean-up."""
    return fill_dno_alias(blank_to_null(df))


def with_substation_nrn(df: DataFrame, source: str = "dataset_id") -> DataFrame:
    """Add ``substation_nrn`` = first 10 characters of the dataset id (PR5)."""
    return df.withColumn("substation_nrn", C.substation_nrn_from_dataset(source))


def overwrite_location(df: DataFrame, looked_up: str = "looked_up_location") -> DataFrame:
    """The looked-up location replaces the file's, even by null (PR6)."""
    return df.withColumn("substation_geo_location", F.col(looked_up)).drop(looked_up)


def with_geometry(df: DataFrame, location: str = "substation_geo_location") -> DataFrame:
    """Point geometry from the 'lat,lng' text (PR11)."""
    return df.withColumn("geometry", C.parse_location(location))


def to_published_types(df: DataFrame) -> DataFrame:
    """Counts and consumption to int64 (half-even), timestamp to ms (PR13)."""
    return df.withColumns(
        {
            "aggregated_device_count_active": C.round_half_even_long("aggregated_device_count_active"),
            "total_consumption_active_import": C.round_half_even_long("total_consumption_active_import"),
            "data_collection_log_timestamp": floor_millisecond("data_collection_log_timestamp"),
        }
    )


def unique_ids(df: DataFrame, dno: str | None = None) -> DataFrame:
    """Substation and feeder ids unique across DNOs (PR14).

    NGED: alias-substation, then -feeder; SSEN: alias-dataset[0:10] and
    alias-dataset. With ``dno`` unset the rule is chosen per row from the
    alias column; another alias is an error.
    """
    nged_sub = C.null_join("-", "dno_alias", "secondary_substation_id")
    nged_feeder = C.null_join("-", nged_sub, "lv_feeder_id")
    ssen_sub = C.null_join("-", "dno_alias", C.substation_nrn_from_dataset("dataset_id"))
    ssen_feeder = C.null_join("-", "dno_alias", "dataset_id")
    if dno is not None:
        key = dno.upper()
        if key == "NGED":
            return df.withColumns({"secondary_substation_unique_id": nged_sub, "lv_feeder_unique_id": nged_feeder})
        if key == "SSEN":
            return df.withColumns({"secondary_substation_unique_id": ssen_sub, "lv_feeder_unique_id": ssen_feeder})
        raise ValueError(f"no rule for the ids of network operator {dno}")
    alias = F.col("dno_alias")
    bad = F.raise_error(F.concat(F.lit("no rule for the ids of network operator "), F.coalesce(alias, F.lit("null"))))
    return df.withColumns(
        {
            "secondary_substation_unique_id": F.when(alias == "NGED", nged_sub).when(alias == "SSEN", ssen_sub).otherwise(bad),
            "lv_feeder_unique_id": F.when(alias == "NGED", nged_feeder).when(alias == "SSEN", ssen_feeder).otherwise(bad),
        }
    )


def published_columns(df: DataFrame) -> DataFrame:
    """The final eight columns in order (PR18)."""
    return df.select(*S.PUBLISHED_COLUMNS)


def to_published(df: DataFrame, dno: str | None = None) -> DataFrame:
    """Staging rows -> published rows: PR11, PR13, PR14, PR18."""
    return published_columns(unique_ids(to_published_types(with_geometry(df)), dno))


def flatten_geometry(df: DataFrame, column: str = "geometry") -> DataFrame:
    """Point struct -> longitude/latitude columns (PR21)."""
    return df.withColumns({"longitude": F.col(column)["x"], "latitude": F.col(column)["y"]}).drop(column)


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Query-time column subset (PR17)."""
    return df.select(*cols)


def with_kwh(df: DataFrame, column: str = "total_consumption_active_import", out: str | None = None) -> DataFrame:
    """Wh -> kWh (PR19)."""
    return df.withColumn(out or column, C.wh_to_kwh(column))


def with_normalised(
    df: DataFrame,
    consumption: str = "total_consumption_active_import",
    devices: str = "aggregated_device_count_active",
    out: str = "normalised_consumption",
) -> DataFrame:
    """Consumption per device (PR20)."""
    return df.withColumn(out, C.normalised(consumption, devices))


def month_list(spark, start: str, end: str | Column) -> DataFrame:
    """Month partition keys from ``start`` to the month of ``end`` inclusive (PR22);
    none if that is earlier."""
    first = F.lit(start).cast("date")
    last = F.trunc((F.lit(end) if isinstance(end, str) else end).cast("date"), "MM")
    months = F.when(last >= first, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    return spark.range(1).select(F.explode(months).alias("month"))


def source_months(spark, source: str, today: str | Column) -> DataFrame:
    """The month partitions a source has on the day ``today`` (PR22): SSEN and the
    combined table with the running month, NGED completed months only, each from
    its first month on."""
    key = source.upper()
    first = {"SSEN": S.SSEN_FIRST_MONTH, "NGED": S.NGED_FIRST_MONTH, "COMBINED": S.COMBINED_FIRST_MONTH}.get(key)
    if first is None:
        raise ValueError(f"no months are known of {source}")
    day = (F.lit(today) if isinstance(today, str) else today).cast("date")
    return month_list(spark, first, F.add_months(day, -1) if key == "NGED" else day)


def stage_mixed_feed(readings: DataFrame, lookup: DataFrame, located_alias: str = "SSEN") -> DataFrame:
    """Staging rules for a feed carrying several DNOs' rows, in one pass.

    Rows of ``located_alias`` take their location from the lookup (JN2,
    PR5, PR6); every other row gets the NGED clean-up (PR3, PR4). The lookup
    join is restricted to the located rows inside the join condition, so the
    feed is scanned once and the (small) lookup is joined without shuffling
    the readings.
    """
    alias = F.col("dno_alias")
    is_located = alias == F.lit(located_alias)
    lk = lookup.select(F.col("substation_nrn").alias("__nrn"), F.col("substation_geo_location").alias("__loc"))
    joined = readings.join(lk, (C.substation_nrn_from_dataset("dataset_id") == F.col("__nrn")) & is_located, "left")
    out = []
    for c in readings.columns:
        col = F.col(c)
        if c == "substation_geo_location":
            out.append(F.when(is_located, F.col("__loc")).otherwise(C.blank_to_null(col)).alias(c))
        elif c == "dno_alias":
            out.append(F.when(is_located, col).otherwise(F.coalesce(C.blank_to_null(col), F.lit(S.NGED_DEFAULT_ALIAS))).alias(c))
        elif c in S.NGED_BLANK_COLUMNS:
            out.append(F.when(is_located, col).otherwise(C.blank_to_null(col)).alias(c))
        else:
            out.append(col)
    return joined.select(*out)
