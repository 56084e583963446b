"""Raw text columns -> typed silver columns."""

from pyspark.sql import Column, DataFrame, functions as F

from orderlake.functions.parsing import parse_date, parse_double, parse_int
from orderlake.functions.text import imputed_region, is_missing
from orderlake.schemas import SILVER_SCHEMA


def flag_and_impute_region(valid: DataFrame) -> DataFrame:
    """`region_is_synthetic` from the raw region, then the region itself: trimmed or `UNKNOWN`."""
    others = [name for name in valid.columns if name not in ("region", "region_is_synthetic")]
    return valid.select(
        imputed_region("region").alias("region"),
        *others,
        is_missing("region").alias("region_is_synthetic"),
    )


def typed_orders(cleaned: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The 19 silver columns. What cannot be read becomes NULL; the year is the parsed date's."""
    moment = F.current_timestamp() if as_of is None else as_of
    texts = ["region", "country", "item_type", "sales_channel", "order_priority", "order_id",
             "_source_file"]
    amounts = ["unit_price", "unit_cost", "total_revenue", "total_cost", "total_profit"]
    columns = {name: F.col(name).cast("string") for name in texts}
    columns |= {name: parse_double(name) for name in amounts}
    columns |= {
        "order_date": parse_date("order_date"),
        "ship_date": parse_date("ship_date"),
        "units_sold": parse_int("units_sold"),
        "order_year": F.year(parse_date("order_date")),
        "region_is_synthetic": F.col("region_is_synthetic").cast("boolean"),
        "_ingested_at": F.col("_ingested_at").cast("timestamp"),
        "_transformed_at": moment.cast("timestamp"),
    }
    return cleaned.select(*[columns[name].alias(name) for name in SILVER_SCHEMA.names])
