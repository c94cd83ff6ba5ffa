"""Dimensions: users, promo codes and rate intervals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.flags import blank_to_null
from ledgerline.functions.keys import surrogate_key
from ledgerline.functions.times import OPEN_END, utc
from ledgerline.operators.asof import next_start
from ledgerline.operators.copies import restore_copies


def lineage(run_ts: datetime | None = None, source: str = "S3") -> list[Column]:
    """Where a built row came from and when; one time for the whole run."""
    moment = F.current_timestamp() if run_ts is None else F.lit(utc(run_ts))
    return [F.lit(source).alias("source"), moment.cast("timestamp").alias("loaded_at")]


def users(raw_users: DataFrame, raw_test_users: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """One row per uuid, in one shuffle: both sources are stacked and aggregated.

    Gives what collapsing the staging users gives, without its joins.
    """
    known = raw_users.select(
        blank_to_null(F.col("user_uuid")).alias("user_uuid"),
        F.coalesce("user_id", F.lit(-1).cast("bigint")).alias("user_id"),
        F.coalesce("is_test_user", F.lit(True)).cast("int").alias("is_test_user"),
        F.col("source_file").alias("user_file"),
        F.lit(None).cast("string").alias("test_file"),
    )
    listed = raw_test_users.select(
        blank_to_null(F.col("test_user_uuid")).alias("user_uuid"),
        F.lit(None).cast("bigint").alias("user_id"),
        F.lit(None).cast("int").alias("is_test_user"),
        F.lit(None).cast("string").alias("user_file"),
        F.col("source_file").alias("test_file"),
    )
    stacked = known.unionByName(listed).where("user_uuid IS NOT NULL").groupBy("user_uuid")
    return stacked.agg(
        F.min("user_id").alias("user_id"),
        F.max("is_test_user").alias("is_test_user"),
        F.max("user_file").alias("user_file"),
        F.max("test_file").alias("test_file"),
    ).select(
        surrogate_key(F.col("user_uuid")).alias("user_key"),
        F.coalesce("user_id", F.lit(-1).cast("bigint")).alias("user_id"),
        "user_uuid",
        F.coalesce("is_test_user", F.lit(1)).alias("is_test_user"),
        F.coalesce("user_file", "test_file").alias("source_file"),
        *lineage(run_ts),
    )


def promo_codes(staged: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """One row per promo; of several the smallest (code, limit, expiry) is taken whole."""
    packed = staged.groupBy("promo_code_id").agg(F.min(F.struct("code", "max_uses", "expiry_date")).alias("_row"))
    return packed.select("promo_code_id", "_row.code", "_row.max_uses", "_row.expiry_date", *lineage(run_ts))


def held_rates(staged: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """The rates that hold, one per currency and time: the greatest (update_id, rate), until the next time.

    ``staged`` may be whole days of the rates, when ``firsts`` has the first rate of each currency and day of all of them.
    """
    dated = staged.where("ts IS NOT NULL")
    starts = dated.groupBy("currency", F.col("ts").alias("valid_from")).agg(F.max(F.struct("update_id", "rate")).alias("_winner"))
    spans = next_start(starts, "currency", "valid_from", "valid_to", OPEN_END, firsts)
    key = surrogate_key(F.col("currency"), F.col("valid_from")).alias("rate_key")
    return spans.select(key, "_winner.update_id", "currency", "valid_from", "valid_to", "_winner.rate")


def exchange_rates(
    staged: DataFrame, run_ts: datetime | None = None, firsts: DataFrame | None = None, held: DataFrame | None = None
) -> DataFrame:
    """Validity intervals per currency, the last one open.

    Of rates that start at the same time the greatest (update_id, rate) holds;
    the others, and further copies of it, get an empty interval. A rate whose
    time could not be read stays, without a key, a start or an end, so that the
    checks on the table see it. ``staged`` may be whole days of the rates, as for
    ``held_rates``; ``held`` is what that gives, where it is there already.
    """
    dated = staged.where("ts IS NOT NULL")
    lost = staged.where("ts IS NULL").select(
        "update_id", "currency", F.col("ts").alias("valid_from"), F.col("ts").alias("valid_to"), "rate"
    )
    rated = dated.groupBy("currency", F.col("ts").alias("valid_from"), "update_id", "rate").agg(
        F.count(F.lit(1)).alias("_copies")
    )
    held = held_rates(staged, firsts) if held is None else held
    spans = held.select("currency", "valid_from", F.struct("update_id", "rate").alias("_winner"), F.col("valid_to").alias("_next"))
    holds = (F.col("_copy") == 1) & F.struct("update_id", "rate").eqNullSafe(F.col("_winner"))
    spanned = (
        restore_copies(rated.join(spans, ["currency", "valid_from"]), "_copies", "_copy")
        .withColumn("valid_to", F.when(holds, F.col("_next")).otherwise(F.col("valid_from")))
        .select("update_id", "currency", "valid_from", "valid_to", "rate")
    )
    return spanned.unionByName(lost).select(
        F.when(F.col("valid_from").isNotNull(), surrogate_key(F.col("currency"), F.col("valid_from"))).alias("rate_key"),
        "update_id",
        "currency",
        "valid_from",
        "valid_to",
        "rate",
        F.coalesce(F.col("valid_to") == F.lit(OPEN_END).cast("timestamp"), F.lit(False)).cast("int").alias("is_current"),
        *lineage(run_ts),
    )
