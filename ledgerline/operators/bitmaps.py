"""Exact distinct counts that can be merged: a bitmap of numbered keys for each day.

Keys get numbers once; a day's keys are stored as bitmaps of 32,768 numbers each. The distinct count of any set of days
is the number of bits that are set in the union of their bitmaps, so a new day adds its own bitmaps and no older day is
read again. Numbers are dense within a range per task, so a bitmap stands for many keys; the union shuffles bitmaps,
not keys, and combines them on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.session import settle


def number_keys(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """``key, number``: a number of its own for every key that is not NULL; keys in ``known`` keep theirs.

    New numbers start at the next multiple of a partition's range above the largest known one. The result is stored,
    as a number must not change when a task is run again.
    """
    found = keys.where(F.col(key).isNotNull()).select(key).distinct()
    first = F.lit(0).cast("bigint")
    if known is not None:
        found = found.join(known, key, "left_anti")
        last = known.agg(F.max("number")).first()[0]
        first = F.lit(0 if last is None else ((last >> 33) + 1) << 33)
    numbered = settle(found.withColumn("number", F.monotonically_increasing_id() + first), "numbered-keys")
    return numbered if known is None else known.select(key, "number").unionByName(numbered)


def day_bitmaps(rows: DataFrame, day: str, key: str, numbers: DataFrame) -> DataFrame:
    """``day, bucket, bits``: the numbers of the keys of each day."""
    held = rows.select(day, key).distinct().join(numbers, key)
    bucket, place = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    return held.groupBy(day, bucket.alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bits"))


def distinct_in(bitmaps: DataFrame, by: list[str], out: str) -> DataFrame:
    """Distinct keys per ``by`` of bitmaps that were assigned to it, as often as they belong to one."""
    united = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(out))


def sliding(bitmaps: DataFrame, day: str, days: int, out: str) -> DataFrame:
    """Distinct keys of the ``days`` that end with each day from the first to the last one."""
    ends = F.explode(F.sequence(F.col(day), F.date_add(day, days - 1)))
    last = bitmaps.agg(F.max(day).alias("last"))
    spread = bitmaps.withColumn("until", ends).join(F.broadcast(last), F.col("until") <= F.col("last"))  # one row
    return distinct_in(spread, ["until"], out)
