"""Typed reads of text fields parsed from JSON.

All fields are parsed as text first, so that numbers sent as text are
accepted and a bad value can be told from a missing one.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerline.functions.flags import is_blank


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def text_or_null(text: Column) -> Column:
    return F.when(~is_blank(text), text)


# Fixed value: a decimal number in plain or scientific notation.
NUMBER = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(text: Column) -> Column:
    """A number of any size as a double; NULL for other text, such as NaN."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def whole_number(text: Column) -> Column:
    """Fractions are cut off; blank or unreadable text, and what a long cannot hold, is NULL."""
    exact = text.try_cast("decimal(38,18)").try_cast("bigint")
    return F.coalesce(text.try_cast("bigint"), exact)


def number_or_zero(text: Column) -> Column:
    return F.when(is_blank(text), F.lit(0.0)).otherwise(number(text))


def unreadable(text: Column) -> Column:
    """A value is there but is not a number."""
    return ~is_blank(text) & number(text).isNull()
