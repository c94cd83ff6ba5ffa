"""Streaming forms of the dedup and the per-minute counts, bounded by watermarks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def first_per_event(rows: DataFrame, delay: str = "60 minutes") -> DataFrame:
    """Drop repeats of an event id that arrive within the delay (keeps the first)."""
    return rows.withWatermark("loaded_at", delay).dropDuplicatesWithinWatermark(["event_id"])


def events_per_minute(feeds: dict[str, DataFrame], delay: str = "60 minutes") -> DataFrame:
    """Arrivals per minute, source and event type, emitted as minutes close."""
    tagged = [
        rows.select("loaded_at", "source", F.lit(event_type).alias("event_type")) for event_type, rows in feeds.items()
    ]
    stacked = reduce(DataFrame.unionByName, tagged).withWatermark("loaded_at", delay)
    counted = stacked.groupBy(F.window("loaded_at", "1 minute"), "source", "event_type").agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return counted.select(F.col("window.start").alias("event_minute"), "source", "event_type", "event_count")
