"""Staging: types, natural keys and quality flags over the raw tables. All lazy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.flags import blank_to_null, flag
from ledgerline.functions.keys import cancellation_key, transaction_key
from ledgerline.functions.times import event_time, lenient_date, lenient_time, rate_time
from ledgerline.operators.collisions import with_group_size
from ledgerline.operators.ordinals import number_rows

# Base currency and the quoted ones with their raw rate columns.
BASE_CURRENCY = "TGRK"
RATE_COLUMNS = {"PUNK": "rate_tgrk_punk", "RUB": "rate_tgrk_rub"}

_KEYED = [
    "transaction_nk",
    "transaction_id",
    "user_id",
    "user_uuid",
    "amount",
    "currency",
    "transaction_type",
    "promo_code_id",
    "status",
    "created_at",
    "source_file",
    "loaded_at",
]


def quality_flags(user_uuid: Column, amount: Column, status: Column, kind: Column) -> dict[str, Column]:
    """Flags are independent of each other; a NULL condition gives 0."""
    return {
        "is_empty_user": flag(user_uuid.isNull()),
        "is_negative_amount": flag(amount < 0),
        "is_zero_amount": flag(amount == 0),
        "is_completed": flag(status == "completed"),
        "is_purchase": flag(kind == "purchase"),
    }


def keyed_transactions(raw: DataFrame) -> DataFrame:
    """Natural key and event time of every raw row."""
    path = F.col("source_file")
    return raw.select(
        transaction_key(path, F.col("transaction_id")).alias("transaction_nk"),
        "transaction_id",
        "user_id",
        blank_to_null(F.col("user_uuid")).alias("user_uuid"),
        "amount",
        "currency",
        "transaction_type",
        "promo_code_id",
        "status",
        event_time(F.col("created_at"), path).alias("created_at"),
        "source_file",
        "loaded_at",
    )


def flagged_transactions(raw: DataFrame) -> DataFrame:
    """Raw rows with key, group size and flags: what facts and marts read.

    All files of a slot must be in ``raw``, as a collision may span files.
    """
    return flagged_rows(keyed_transactions(raw))


def flagged_rows(keyed: DataFrame) -> DataFrame:
    """The same over rows that are keyed already, whole file days of them."""
    sized = with_group_size(keyed, "transaction_nk", "transaction_dup_cnt")
    flags = quality_flags(F.col("user_uuid"), F.col("amount"), F.col("status"), F.col("transaction_type"))
    return sized.withColumns(
        {"is_transaction_duplicate": flag(F.col("transaction_dup_cnt") > 1), **flags}
    )


def transactions(flagged: DataFrame) -> DataFrame:
    """Staging transactions in full, with the position of each row in its key group.

    Only colliding rows need a position other than 1, so only they are numbered.
    """
    columns = [
        *_KEYED,
        "transaction_dup_rn",
        "transaction_dup_cnt",
        "is_transaction_duplicate",
        "is_empty_user",
        "is_negative_amount",
        "is_zero_amount",
        "is_completed",
        "is_purchase",
    ]
    single = flagged.where("is_transaction_duplicate = 0").withColumn(
        "transaction_dup_rn", F.lit(1).cast("bigint")
    )
    grouped = number_rows(
        flagged.where("is_transaction_duplicate = 1"), "transaction_nk", "created_at", "transaction_dup_rn"
    )
    return single.select(*columns).unionByName(grouped.select(*columns))


def cancellations(raw: DataFrame) -> DataFrame:
    return raw.select(
        cancellation_key(F.col("source_file"), F.col("cancellation_id")).alias("cancellation_nk"),
        "cancellation_id",
        "original_transaction_id",
        "reason",
        lenient_time(F.col("cancelled_at")).alias("cancelled_at"),
        "refund_amount",
        "source_file",
        "loaded_at",
    )


def exchange_rates(raw: DataFrame) -> DataFrame:
    """One row per update and currency, and rate 1 of the base currency since 1970."""
    pairs = ", ".join(f"'{currency}', {column}" for currency, column in RATE_COLUMNS.items())
    quoted = raw.withColumn("ts", rate_time(F.col("timestamp"))).select(
        "update_id",
        "ts",
        F.expr(f"stack({len(RATE_COLUMNS)}, {pairs}) as (currency, rate)"),
        "source_file",
        "loaded_at",
    )
    seed = raw.sparkSession.range(1).select(
        F.lit(1).cast("bigint").alias("update_id"),
        F.lit("1970-01-01 00:00:00").cast("timestamp").alias("ts"),
        F.lit(BASE_CURRENCY).alias("currency"),
        F.lit(1.0).alias("rate"),
        F.lit("manual").alias("source_file"),
        F.current_timestamp().alias("loaded_at"),
    )
    return quoted.unionByName(seed)


def users(raw_users: DataFrame, raw_test_users: DataFrame) -> DataFrame:
    """Every uuid of either source; the user row wins, a test-only uuid is a test user.

    The test list counts as a set of uuids, so repeats in it do not multiply rows.
    """
    known = raw_users.withColumn("user_uuid", blank_to_null(F.col("user_uuid")))
    listed = (
        raw_test_users.select(
            blank_to_null(F.col("test_user_uuid")).alias("user_uuid"), F.struct("source_file", "loaded_at").alias("_row")
        )
        .groupBy("user_uuid")
        .agg(F.min("_row").alias("_row"))
        .select(
            "user_uuid",
            F.col("_row.source_file").alias("_test_file"),
            F.col("_row.loaded_at").alias("_test_loaded_at"),
        )
    )
    every = known.select("user_uuid").unionByName(listed.select("user_uuid")).distinct()
    return (
        every.join(known, "user_uuid", "left")
        .join(listed, "user_uuid", "left")
        .select(
            F.coalesce("user_id", F.lit(-1).cast("bigint")).alias("user_id"),
            "user_uuid",
            F.coalesce("is_test_user", F.lit(True)).alias("is_test_user"),
            F.coalesce("source_file", "_test_file").alias("source_file"),
            F.coalesce("loaded_at", "_test_loaded_at").alias("loaded_at"),
        )
    )


def promo_codes(raw: DataFrame) -> DataFrame:
    return raw.select(
        "promo_code_id",
        "code",
        "max_uses",
        lenient_date(F.col("expiry_date")).alias("expiry_date"),
        "source_file",
        "loaded_at",
    )
