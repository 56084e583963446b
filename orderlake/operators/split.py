"""Bronze rows without an order key go to quarantine, all others on to silver."""

from pyspark.sql import Column, DataFrame, functions as F

from orderlake.functions.text import is_missing
from orderlake.schemas import DATA_COLUMNS, MISSING_ORDER_ID, QUARANTINE_SCHEMA


def missing_order(bronze: DataFrame) -> DataFrame:
    return bronze.filter(is_missing("order_id"))


def valid_order(bronze: DataFrame) -> DataFrame:
    return bronze.filter(~is_missing("order_id"))


def quarantine(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The 18 quarantine columns of the rows without an order key."""
    moment = F.current_timestamp() if as_of is None else as_of
    return missing_order(bronze).select(
        *[F.col(name).cast("string").alias(name) for name in DATA_COLUMNS],
        F.col("_ingested_at").cast("timestamp").alias("_ingested_at"),
        F.col("_source_file").cast("string").alias("_source_file"),
        F.lit(MISSING_ORDER_ID).alias("_quarantine_reason"),
        moment.cast("timestamp").alias("_quarantined_at"),
    ).select(*QUARANTINE_SCHEMA.names)
