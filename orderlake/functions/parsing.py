r"""Text to typed values. What cannot be read becomes NULL, whatever the session's ANSI mode.

Integers follow Spark's non-ANSI cast, which `try_cast` does not: a fraction is cut off
('12.7' -> 12, '.5' -> 0), exponents are refused, control characters around the number are
ignored. The pattern decides whether the text is such a number; only its whole part is cast.
The end is anchored with `\z`, as `$` would let a trailing Unicode line separator pass.
"""

from pyspark.sql import Column, functions as F

from orderlake.schemas import DATE_PATTERN

_BLANK = r"[\x00-\x20\x7f]*"
_NUMBER = rf"\A{_BLANK}[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]*){_BLANK}\z"
_SIGN_AND_WHOLE_PART = rf"\A{_BLANK}([+-]?)([0-9]*)"


def parse_int(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    sign = F.regexp_extract(value, _SIGN_AND_WHOLE_PART, 1)
    whole = F.regexp_extract(value, _SIGN_AND_WHOLE_PART, 2)
    # Most values are plain digits: the regular expressions run only on the rest.
    return F.coalesce(
        value.try_cast("int"),
        F.when(value.rlike(_NUMBER), F.concat(sign, F.lit("0"), whole).try_cast("int")),
    )


def parse_double(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.try_cast("double")


def parse_date(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.try_to_date(value, DATE_PATTERN)
