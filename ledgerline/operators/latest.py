"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_per_key(df: DataFrame, key: list[str], by: str) -> DataFrame:
    """Keep the row with the greatest ``by`` per key.

    A maximum over the packed row combines on the map side, so a key with many
    versions is reduced before the shuffle; ties go to the greater row.
    """
    rest = [c for c in df.columns if c not in key and c != by]
    packed = df.groupBy(*key).agg(F.max(F.struct(by, *rest)).alias("_row"))
    picked = [F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns]
    return packed.select(*picked)
