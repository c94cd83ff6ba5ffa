"""Row counts of tables, and the quarantine in key order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name and rows, one row per table."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def ordered_quarantine(quarantined: DataFrame) -> DataFrame:
    """Key order for reading; the time splits a large key over sort ranges."""
    return quarantined.orderBy("transaction_nk", "created_at")
