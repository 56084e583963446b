"""Validation queries over the three layers."""

from pyspark.sql import DataFrame, functions as F


def layer_counts(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row per layer with its number of rows."""
    layers = {"bronze": bronze, "silver": silver, "quarantine": quarantine}
    counts = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, frame in layers.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def duplicate_orders(layer: DataFrame) -> DataFrame:
    """Order keys with more than one row; empty for a sound silver table."""
    return (
        layer.groupBy("order_id")
        .agg(F.count("*").alias("duplicate_count"))
        .filter("duplicate_count > 1")
    )
