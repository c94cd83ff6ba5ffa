"""Combine several aggregates that share a key, as a full outer join would."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def combine(parts: list[DataFrame], keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key found in any part; a column a part lacks is NULL.

    Every part holds at most one row per key, so one union and one aggregate
    give what a distinct key spine with a LEFT join per part gives.
    """

    def widen(part: DataFrame) -> DataFrame:
        def cell(name: str) -> Column:
            return F.col(name) if name in part.columns else F.lit(None).alias(name)

        return part.select(*keys, *[cell(c) for c in columns])

    tall = reduce(DataFrame.unionByName, [widen(p) for p in parts])
    return tall.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])
