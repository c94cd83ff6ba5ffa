"""LEFT equi lookup into a dimension when the key is often NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def left_lookup(left: DataFrame, dim: DataFrame, key: str, spread: str, fields: dict[str, str]) -> DataFrame:
    """Add dimension ``fields`` (source name to output name) by ``key``.

    No strategy is forced: Catalyst broadcasts a dimension it knows to be small
    and otherwise shuffles. For the shuffle a second equi key is added, the
    hash of the key, which for NULL keys is the hash of ``spread`` instead: the
    rows without a key never match, and scatter instead of meeting in one task.
    """
    side = dim.select(
        F.col(key).alias("_key"),
        F.xxhash64(key).alias("_hash"),
        *[F.col(name).alias(out) for name, out in fields.items()],
    )
    scatter = F.when(F.col(key).isNull(), F.xxhash64(spread)).otherwise(F.xxhash64(key))
    rows = left.withColumn("_spread", scatter)
    matched = (F.col(key) == F.col("_key")) & (F.col("_spread") == F.col("_hash"))
    return rows.join(side, matched, "left").drop("_key", "_hash", "_spread")
