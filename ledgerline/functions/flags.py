"""0/1 flags, conditional aggregates and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def blank_to_null(text: Column) -> Column:
    """Empty text becomes NULL; white space stays."""
    return F.nullif(text, F.lit(""))


def is_blank(text: Column) -> Column:
    """NULL, empty or white space only."""
    return text.isNull() | text.rlike(r"^\s*$")


def sum_if(value: Column, condition: Column) -> Column:
    """Sum over the rows that meet the condition; NULL without a hit."""
    return F.sum(F.when(condition, value))


def sum_if_or_zero(value: Column, condition: Column) -> Column:
    return F.coalesce(sum_if(value, condition), F.lit(0.0))


def convert(amount: Column, rate: Column) -> Column:
    """Amount in the base currency; NULL when the rate is absent or 0."""
    return F.try_divide(amount, F.nullif(rate, F.lit(0.0)))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))
