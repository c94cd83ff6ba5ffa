"""Rolling 60-minute views over the stream tables, read as of a given time."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.flags import share, sum_if_or_zero
from ledgerline.functions.times import utc
from ledgerline.plans.marts import bought
from ledgerline.streaming.feeds import SOURCE

WINDOW = "INTERVAL 60 MINUTES"


def _times(as_of: datetime | None) -> tuple[Column, Column]:
    moment = F.current_timestamp() if as_of is None else F.lit(utc(as_of)).cast("timestamp")
    return moment, moment - F.expr(WINDOW)


def recent(rows: DataFrame, as_of: datetime | None) -> DataFrame:
    """Rows that arrived in the last 60 minutes; the bounds are pushed down to the files.

    For a given ``as_of`` later arrivals are left out, as they were not there yet.
    """
    now, start = _times(as_of)
    kept = rows.where(F.col("loaded_at") >= start)
    return kept if as_of is None else kept.where(F.col("loaded_at") <= now)


def current_hour_metrics(transactions: DataFrame, as_of: datetime | None = None) -> DataFrame:
    now, start = _times(as_of)
    return (
        recent(transactions, as_of)
        .groupBy("currency")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.count_if(F.col("is_purchase") == 1).alias("purchase_type_count"),
            F.count_if(F.col("is_completed") == 1).alias("completed_count"),
            F.count_if(bought()).alias("completed_purchase_count"),
            F.sum("amount").alias("amount_original"),
            sum_if_or_zero(F.col("amount"), bought()).alias("completed_purchase_amount_original"),
            F.count_if(F.col("is_negative_amount") == 1).alias("negative_amount_count"),
            F.count_if(F.col("is_zero_amount") == 1).alias("zero_amount_count"),
            F.count_if(F.col("is_empty_user") == 1).alias("empty_user_count"),
            F.max("loaded_at").alias("last_loaded_at"),
        )
        .select(
            F.date_trunc("hour", now).alias("current_hour"),
            start.alias("window_started_at"),
            now.alias("calculated_at"),
            F.lit(SOURCE).alias("source"),
            "transaction_count",
            "purchase_type_count",
            "completed_count",
            "completed_purchase_count",
            "currency",
            "amount_original",
            "completed_purchase_amount_original",
            "negative_amount_count",
            "zero_amount_count",
            "empty_user_count",
            "last_loaded_at",
        )
    )


def events_per_minute(
    transactions: DataFrame, cancellations: DataFrame, rates: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    feeds = {"transaction": transactions, "cancellation": cancellations, "exchange_rate": rates}
    tagged = [
        recent(rows, as_of).select(
            F.date_trunc("minute", "loaded_at").alias("event_minute"), "source", F.lit(kind).alias("event_type")
        )
        for kind, rows in feeds.items()
    ]
    stacked = reduce(DataFrame.unionByName, tagged)
    return stacked.groupBy("event_minute", "source", "event_type").agg(F.count(F.lit(1)).alias("event_count"))


def top_minutes(per_minute: DataFrame, limit: int = 10) -> DataFrame:
    """The latest minutes first; ties within a minute in name order."""
    return per_minute.orderBy(F.desc("event_minute"), "source", "event_type").limit(limit)


def data_quality(transactions: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One row even for an empty window, with shares of 0 then."""
    now, start = _times(as_of)
    counts = recent(transactions, as_of).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if(F.col("is_empty_user") == 1).alias("empty_user_count"),
        F.count_if(F.col("is_negative_amount") == 1).alias("negative_amount_count"),
        F.count_if(F.col("is_zero_amount") == 1).alias("zero_amount_count"),
        F.count_if(F.col("is_transaction_duplicate") == 1).alias("duplicate_transaction_count"),
    )
    total = F.col("transaction_count")
    return counts.select(
        start.alias("window_started_at"),
        now.alias("calculated_at"),
        F.lit(SOURCE).alias("source"),
        "transaction_count",
        "empty_user_count",
        "negative_amount_count",
        "zero_amount_count",
        "duplicate_transaction_count",
        share(F.col("empty_user_count"), total).alias("empty_user_share"),
        share(F.col("negative_amount_count"), total).alias("negative_amount_share"),
        share(F.col("zero_amount_count"), total).alias("zero_amount_share"),
    )
