"""Schemas, sort orders and fixed values of the smart-meter data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the published data's conventions.
# ---------------------------------------------------------------------------

# Network operators ("DNOs") known to the data model, and the two processed.
DNO_CODES = ["nged", "npg", "ukpn", "ssen", "enwl", "spen"]
PROCESSED_DNOS = ["NGED", "SSEN"]

# Text values that NGED files use for "no value"; they become null in five
# text columns.
NGED_BLANK_TOKENS = ["", " ", ",", " ,", ", ", " , "]
NGED_BLANK_COLUMNS = [
    "dataset_id",
    "dno_alias",
    "secondary_substation_name",
    "lv_feeder_name",
    "substation_geo_location",
]
NGED_DEFAULT_ALIAS = "NGED"

# NGED part files spell some headers differently.
NGED_RENAMES = {
    "LV_feeder_ID": "lv_feeder_id",
    "LV_feeder_name": "lv_feeder_name",
    "aggregated_device_count_Active": "aggregated_device_count_active",
    "Total_consumption_active_import": "total_consumption_active_import",
    "Insert_time": "insert_time",
}

# Full header of an SSEN daily file, in file order.
SSEN_CSV_COLUMNS = [
    "dataset_id",
    "dno_name",
    "dno_alias",
    "secondary_substation_id",
    "secondary_substation_name",
    "lv_feeder_id",
    "lv_feeder_name",
    "substation_geo_location",
    "aggregated_device_count_active",
    "primary_consumption_active_import",
    "secondary_consumption_active_import",
    "total_consumption_active_import",
    "aggregated_device_count_reactive",
    "total_consumption_reactive_import",
    "data_collection_log_timestamp",
    "insert_time",
    "last_modified_time",
]

# Full header of an NGED part file, in file order.
NGED_CSV_COLUMNS = [
    "dataset_id",
    "dno_name",
    "dno_alias",
    "secondary_substation_id",
    "secondary_substation_name",
    "LV_feeder_ID",
    "LV_feeder_name",
    "substation_geo_location",
    "aggregated_device_count_Active",
    "Primary_consumption_active_import",
    "Secondary_consumption_active_import",
    "Total_consumption_active_import",
    "Aggregated_device_count_reactive",
    "Total_consumption_reactive_import",
    "data_collection_log_timestamp",
    "Insert_time",
    "last_modified_time",
]

# Postcode directory values that mean "no coordinate", per column.
POSTCODE_NULL_LAT = "99.999999"
POSTCODE_NULL_LONG = "0.000000"
POSTCODE_FILE_PATTERN = r"(?i)onspd_.*\.csv$"
SHORTEST_POSTCODE = 5

# Substation area plausibility (metres, square metres).
MAX_LINE_LENGTH_M = 100.0
MAX_POLYGON_AREA_M2 = 10_000.0
MAX_POLYGON_MEAN_EDGE_M = 100.0

# Query-side outlier cut on consumption (Wh per half hour).
OUTLIER_WH = 20_000

# Listing file-name patterns.
NGED_PART_FILE_PATTERN = r"^aggregated-smart-meter-data-lv-feeder-\d{4}-\d{2}-part\d{4}\.csv"
SSEN_DAILY_FILE_FORMAT = "yyyy-MM-dd"

# Month partition domains.
SSEN_FIRST_MONTH = "2024-02-01"
NGED_FIRST_MONTH = "2024-01-01"
COMBINED_FIRST_MONTH = "2024-01-01"

# British National Grid transverse Mercator on the Airy 1830 ellipsoid.
BNG_LAT0_DEG = 49.0
BNG_LON0_DEG = -2.0
BNG_K0 = 0.9996012717
BNG_E0 = 400_000.0
BNG_N0 = -100_000.0
AIRY_A = 6_377_563.396
AIRY_B = 6_356_256.909

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

TEXT_COLUMNS = [
    "dataset_id",
    "dno_alias",
    "secondary_substation_id",
    "secondary_substation_name",
    "lv_feeder_id",
    "lv_feeder_name",
    "substation_geo_location",
]
FLOAT_COLUMNS = ["aggregated_device_count_active", "total_consumption_active_import"]
TIME_COLUMNS = ["data_collection_log_timestamp", "insert_time", "last_modified_time"]
CANONICAL_COLUMNS = TEXT_COLUMNS + FLOAT_COLUMNS + TIME_COLUMNS

STAGING_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in TEXT_COLUMNS]
    + [T.StructField(c, T.DoubleType()) for c in FLOAT_COLUMNS]
    + [T.StructField(c, T.TimestampType()) for c in TIME_COLUMNS]
)
STAGING_SORT = [
    "data_collection_log_timestamp",
    "dno_alias",
    "secondary_substation_id",
    "lv_feeder_id",
]

POINT_TYPE = T.StructType(
    [T.StructField("x", T.DoubleType(), False), T.StructField("y", T.DoubleType(), False)]
)

PUBLISHED_COLUMNS = [
    "dataset_id",
    "dno_alias",
    "aggregated_device_count_active",
    "total_consumption_active_import",
    "data_collection_log_timestamp",
    "geometry",
    "secondary_substation_unique_id",
    "lv_feeder_unique_id",
]
PUBLISHED_SCHEMA = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("dno_alias", T.StringType()),
        T.StructField("aggregated_device_count_active", T.LongType()),
        T.StructField("total_consumption_active_import", T.LongType()),
        T.StructField("data_collection_log_timestamp", T.TimestampType()),
        T.StructField("geometry", POINT_TYPE),
        T.StructField("secondary_substation_unique_id", T.StringType()),
        T.StructField("lv_feeder_unique_id", T.StringType()),
    ]
)
PUBLISHED_SORT = [
    "data_collection_log_timestamp",
    "dno_alias",
    "secondary_substation_unique_id",
    "lv_feeder_unique_id",
]

LOOKUP_COLUMNS = ["substation_nrn", "substation_geo_location"]

MAPPING_COLUMNS = [
    "dataset_id",
    "postcode",
    "primary_substation_id",
    "primary_substation_name",
    "hv_feeder_id",
    "hv_feeder_name",
    "secondary_substation_id",
    "secondary_substation_name",
    "lv_feeder_id",
    "lv_feeder_name",
    "total_mpan_count",
]
