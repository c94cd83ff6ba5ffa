"""Key collisions: counts per natural key without moving the rows.

Only the keys are shuffled, and they are counted on the map side first, so a
key held by a third of all rows arrives as one partial count per task. The
colliding keys alone are written out; as that table is small in sound data the
rows are flagged by a broadcast lookup and the fact is never shuffled for it.
When it is not small, Catalyst sees its true size and takes a sort-merge join,
whose left side AQE splits where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.session import settle


def colliding_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with their row count ``n``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def with_group_size(df: DataFrame, key: str, size: str) -> DataFrame:
    """Add the number of rows sharing the key."""
    keys = settle(colliding_keys(df, key), "colliding-keys").select(
        F.col(key).alias("_key"), F.col("n").alias("_n")
    )
    joined = df.join(keys, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(size, F.coalesce("_n", F.lit(1).cast("bigint"))).drop("_key", "_n")


def distinct_per(df: DataFrame, by: str, value: Column, aggregates: list[Column], merged: list[Column]) -> DataFrame:
    """Aggregate per ``by`` with an exact distinct count of ``value`` as ``groups``.

    ``value`` is NULL on rows that do not count, so those collapse on the map
    side; ``merged`` folds the partial columns of ``aggregates``.
    """
    partial = df.groupBy(by, value.alias("_value")).agg(*aggregates)
    return partial.groupBy(by).agg(F.count("_value").alias("groups"), *merged)
