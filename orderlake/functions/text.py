"""Missing-value rules for text columns."""

from pyspark.sql import Column, functions as F

from orderlake.schemas import UNKNOWN_REGION


def is_missing(column: str | Column) -> Column:
    """NULL or only spaces. Never NULL itself, so its negation is safe.

    `trim` takes off spaces only: a value of one tab is not missing.
    """
    value = F.col(column) if isinstance(column, str) else column
    return value.isNull() | (F.trim(value) == "")


def imputed_region(column: str | Column = "region") -> Column:
    """The trimmed region, or the stand-in where it is missing."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when(is_missing(value), F.lit(UNKNOWN_REGION)).otherwise(F.trim(value))
