"""Column names, types and order of every table; all of it is part of the data contract."""

from pyspark.sql import types as T

# Header of the source CSV -> bronze column, in bronze column order.
HEADER_MAP = {
    "Region": "region",
    "Country": "country",
    "Item Type": "item_type",
    "Sales Channel": "sales_channel",
    "Order Priority": "order_priority",
    "Order Date": "order_date",
    "Order ID": "order_id",
    "Ship Date": "ship_date",
    "Units Sold": "units_sold",
    "Unit Price": "unit_price",
    "Unit Cost": "unit_cost",
    "Total Revenue": "total_revenue",
    "Total Cost": "total_cost",
    "Total Profit": "total_profit",
}

DATA_COLUMNS = list(HEADER_MAP.values())
DATE_PATTERN = "M/d/yyyy"
UNKNOWN_REGION = "UNKNOWN"
MISSING_ORDER_ID = "missing_order_id"


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_text = [(name, T.StringType()) for name in DATA_COLUMNS]

BRONZE_SCHEMA = _struct(
    *_text,
    ("_ingested_at", T.TimestampType()),
    ("_source_file", T.StringType()),
    ("_checksum_sha256", T.StringType()),
)

SILVER_SCHEMA = _struct(
    ("region", T.StringType()),
    ("country", T.StringType()),
    ("item_type", T.StringType()),
    ("sales_channel", T.StringType()),
    ("order_priority", T.StringType()),
    ("order_date", T.DateType()),
    ("order_id", T.StringType()),
    ("ship_date", T.DateType()),
    ("units_sold", T.IntegerType()),
    ("unit_price", T.DoubleType()),
    ("unit_cost", T.DoubleType()),
    ("total_revenue", T.DoubleType()),
    ("total_cost", T.DoubleType()),
    ("total_profit", T.DoubleType()),
    ("order_year", T.IntegerType()),
    ("region_is_synthetic", T.BooleanType()),
    ("_ingested_at", T.TimestampType()),
    ("_source_file", T.StringType()),
    ("_transformed_at", T.TimestampType()),
)

QUARANTINE_SCHEMA = _struct(
    *_text,
    ("_ingested_at", T.TimestampType()),
    ("_source_file", T.StringType()),
    ("_quarantine_reason", T.StringType()),
    ("_quarantined_at", T.TimestampType()),
)

# The ledger is stored as events; `seq` orders them and `op` says put (replace) or set (merge).
LEDGER_ATTRIBUTES = _struct(
    ("status", T.StringType()),
    ("landing_key", T.StringType()),
    ("uploaded_at", T.StringType()),
    ("size_bytes", T.LongType()),
    ("processing_started_at", T.StringType()),
    ("bronze_loaded_at", T.StringType()),
    ("bronze_row_count", T.LongType()),
    ("completed_at", T.StringType()),
    ("archive_key", T.StringType()),
    ("silver_run_id", T.StringType()),
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("checksum_sha256", T.StringType()),
        *LEDGER_ATTRIBUTES.fields,
    ]
)

# One row per ZIP of a batch, written once per batch so that no later step reads the ZIPs for it.
MANIFEST_SCHEMA = _struct(
    ("path", T.StringType()),
    ("landing_key", T.StringType()),
    ("landed_at", T.TimestampType()),
    ("size_bytes", T.LongType()),
    ("checksum_sha256", T.StringType()),
    ("member", T.StringType()),
    ("csv_members", T.IntegerType()),
    ("member_bytes", T.LongType()),
    ("header", T.StringType()),
    ("most_fields", T.IntegerType()),
    ("error", T.StringType()),
)

LOAD_REPORT_SCHEMA = _struct(
    ("ingest_batch", T.StringType()),
    ("landing_key", T.StringType()),
    ("checksum_sha256", T.StringType()),
    ("outcome", T.StringType()),
    ("row_count", T.LongType()),
    ("missing_region", T.LongType()),
    ("missing_order_id", T.LongType()),
    ("archive_key", T.StringType()),
    ("unmatched_headers", T.ArrayType(T.StringType())),
    ("detail", T.StringType()),
)

REFRESH_REPORT_SCHEMA = _struct(
    ("silver_run_id", T.StringType()),
    ("raw_count", T.LongType()),
    ("clean_count", T.LongType()),
    ("duplicate_count", T.LongType()),
    ("silver_count", T.LongType()),
    ("quarantine_count", T.LongType()),
    ("synthetic_region_count", T.LongType()),
)

FAILURE_SCHEMA = _struct(
    ("run_id", T.StringType()),
    ("failed_at", T.TimestampType()),
    ("error", T.StringType()),
)
