"""Counts about loads and refreshes. Each is one aggregate over at most two data columns."""

from pyspark.sql import DataFrame, functions as F

from orderlake.functions.text import is_missing

IDENTITY = "raw_count = quarantine_count + duplicate_count + silver_count"
# What is counted; the rest of a report follows from it.
COUNTS = ["raw_count", "quarantine_count", "synthetic_region_count", "silver_count"]


def load_metrics(bronze: DataFrame) -> DataFrame:
    """Per source file: rows, rows without region, rows without order key.

    `missing_region` counts rows without order key too, unlike `synthetic_region_count` below.
    """
    return bronze.groupBy("_source_file").agg(
        F.count("*").alias("row_count"),
        F.count_if(is_missing("region")).alias("missing_region"),
        F.count_if(is_missing("order_id")).alias("missing_order_id"),
    )


def refresh_metrics(bronze: DataFrame) -> DataFrame:
    """One row: all rows, rows for quarantine, and valid rows (before deduplication) whose region
    is stood in for."""
    return bronze.agg(
        F.count("*").alias("raw_count"),
        F.count_if(is_missing("order_id")).alias("quarantine_count"),
        F.count_if(~is_missing("order_id") & is_missing("region")).alias("synthetic_region_count"),
    )


def refresh_report(metrics: DataFrame, silver: DataFrame) -> DataFrame:
    """The six counts of a refresh on one row."""
    return report_of_counts(metrics.crossJoin(silver.agg(F.count("*").alias("silver_count"))))


def report_of_counts(counted: DataFrame) -> DataFrame:
    """`COUNTS` -> the six counts of a report."""
    clean = F.col("raw_count") - F.col("quarantine_count")
    return counted.select(
        "raw_count",
        clean.alias("clean_count"),
        (clean - F.col("silver_count")).alias("duplicate_count"),
        "silver_count",
        "quarantine_count",
        "synthetic_region_count",
    )
