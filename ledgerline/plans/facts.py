"""Facts: enriched transactions, cancellations, their matches, and the quarantine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.flags import convert, flag
from ledgerline.functions.times import hours_crossed
from ledgerline.operators.asof import asof_left_join
from ledgerline.operators.lookup import left_lookup
from ledgerline.plans.dims import lineage
from ledgerline.session import bloom_joins, fits_broadcast, selective, settle


def transactions(
    flagged: DataFrame,
    users: DataFrame,
    promos: DataFrame,
    rates: DataFrame,
    run_ts: datetime | None = None,
    **asof_options: int,
) -> DataFrame:
    """Transactions free of key collisions, with user, promo and rate.

    ``rates`` should be a stored table: its shape decides the as-of strategy.
    With small dimensions the rows go from scan to output without a shuffle.
    """
    clean = flagged.where("is_transaction_duplicate = 0")
    known = left_lookup(
        clean, users, "user_uuid", "transaction_nk", {"user_uuid": "_known_uuid", "is_test_user": "_is_test"}
    )
    offered = left_lookup(
        known,
        promos,
        "promo_code_id",
        "transaction_nk",
        {"code": "promo_code", "max_uses": "promo_max_uses", "expiry_date": "promo_expiry_date"},
    )
    rated = asof_left_join(
        offered,
        rates,
        by="currency",
        at="created_at",
        start="valid_from",
        end="valid_to",
        fields={"rate": "exchange_rate", "rate_key": "rate_key"},
        spread="transaction_nk",
        times=flagged.select("currency", "created_at"),
        **asof_options,
    )
    used = F.col("promo_code_id").isNotNull()
    return rated.select(
        "transaction_nk",
        "transaction_id",
        "user_id",
        "user_uuid",
        F.coalesce("_is_test", F.lit(0)).alias("is_test_user"),
        flag(F.col("_known_uuid").isNull() & F.col("user_uuid").isNotNull()).alias("is_unknown_user"),
        "amount",
        "currency",
        "exchange_rate",
        "rate_key",
        flag(F.coalesce("exchange_rate", F.lit(0.0)) == 0).alias("is_rate_missing"),
        convert(F.col("amount"), F.col("exchange_rate")).alias("amount_tgrk"),
        "transaction_type",
        "promo_code_id",
        "promo_code",
        "promo_max_uses",
        "promo_expiry_date",
        "status",
        "created_at",
        "is_empty_user",
        "is_negative_amount",
        "is_zero_amount",
        "is_completed",
        "is_purchase",
        flag(used).alias("is_promo_used"),
        flag(used & (F.coalesce("promo_code", F.lit("")) == "")).alias("is_unknown_promo"),
        flag(used & (F.to_date("created_at") > F.col("promo_expiry_date"))).alias("is_promo_expired"),
        *lineage(run_ts),
    )


def by_day(fact: DataFrame) -> DataFrame:
    """The fact with the column it is partitioned by when it is stored."""
    return fact.withColumn(BY_DAY, F.to_date("created_at"))


def quarantine(flagged: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Every row of a colliding key, the first one included."""
    return flagged.where("is_transaction_duplicate = 1").select(
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
        "transaction_dup_cnt",
        "is_transaction_duplicate",
        *lineage(run_ts),
    )


def cancellations(staged: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return staged.select(
        "cancellation_nk",
        "cancellation_id",
        "original_transaction_id",
        "reason",
        "cancelled_at",
        "refund_amount",
        *lineage(run_ts),
    )


#: The date that a stored fact is partitioned by.
BY_DAY = "created_day"
MATCH_KEYS = ["_id", "_amount", "_day"]
PICKED = ["transaction_nk", "created_at", "amount_tgrk", "currency", "is_test_user"]


def _exact(amount: Column) -> Column:
    """Absolute value as text, which is exact for a double.

    Spark wraps double keys to normalise them, differently in a join and in an
    aggregate, and would shuffle again between the two; text keys it does not.
    """
    return F.abs(amount).cast("string")


def _candidates(targets: DataFrame) -> DataFrame:
    """Per match key the number of transactions, and the only one where there is just one.

    Of a single row the least value of each column is the row, so the rows are read once.
    """
    least = [F.min(c).alias(c) for c in PICKED]
    counted = targets.groupBy(*MATCH_KEYS).agg(F.count(F.lit(1)).alias("_n"), *least)
    return counted.select(*MATCH_KEYS, "_n", F.when(F.col("_n") == 1, F.struct(*PICKED)).alias("_pick"))


def _on_days(fact: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of the days that some key asks for.

    A fact that is stored by day (``created_day``) is pruned to the partitions of those very days while it runs, so
    that one stray date costs one day more; else the first and last day bound what is read.
    """
    if BY_DAY not in fact.columns:
        days = keys.agg(F.min("_day").alias("first"), F.max("_day").alias("last")).first()
        low, high = (F.lit(days[c]) for c in ("first", "last"))
        return fact.where(F.col("created_at").between(low.cast("timestamp"), F.date_add(high, 1).cast("timestamp")))
    days = settle(keys.select("_day").distinct(), "cancelled-days")
    # The condition is always true; it tells Spark that these days leave others out.
    asked = days.where(F.col("_day") >= F.lit("0001-01-01").cast("date"))
    side = F.broadcast(asked) if fits_broadcast(days) else asked
    return fact.join(side, F.col(BY_DAY) == F.col("_day"), "left_semi")


def cancellation_matches(cancelled: DataFrame, fact: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Match each cancellation to transactions of the previous day by id and |amount|.

    Both sides are aggregated by the match key before they meet, so that a key
    with m transactions and n cancellations costs m + n rows, never m * n pairs.
    Transactions outside the cancelled keys are dropped first when the list of
    those keys is counted to be small enough to broadcast.
    """
    columns = ["cancellation_id", "original_transaction_id", "reason", "cancelled_at", "refund_amount"]
    asked = (
        cancelled.groupBy("cancellation_nk", *columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumns(
            {
                "_id": F.col("original_transaction_id"),
                "_amount": _exact(F.col("refund_amount")),
                "_day": F.date_add(F.to_date("cancelled_at"), -1),
            }
        )
    )
    keys = settle(asked.select(*MATCH_KEYS).where("_day IS NOT NULL").distinct(), "cancelled-keys")
    # Transaction id 0 stands for "none" and is no match target. Days without a cancellation are not read.
    fact = _on_days(fact, keys)
    targets = fact.where("transaction_id != 0").select(
        F.col("transaction_id").alias("_id"),
        _exact(F.col("amount")).alias("_amount"),
        F.to_date("created_at").alias("_day"),
        *PICKED,
    )
    if fits_broadcast(keys):
        targets = targets.join(F.broadcast(keys), MATCH_KEYS, "left_semi")
        candidates = settle(_candidates(targets), "match-candidates")
    else:
        with bloom_joins(fact.sparkSession):
            candidates = settle(_candidates(targets.join(selective(keys, "_id"), MATCH_KEYS, "left_semi")), "match-candidates")
    # One cancellation key may stand for several rows; each row adds the candidates of its own match key.
    answered = (
        asked.join(candidates, MATCH_KEYS, "left")
        .groupBy("cancellation_nk")
        .agg(
            F.min(F.struct(*columns)).alias("_first"),
            F.coalesce(F.sum(F.col("_n") * F.col("_copies")), F.lit(0)).alias("candidate_count"),
            F.min("_pick").alias("_pick"),
        )
        .select("cancellation_nk", "_first.*", "candidate_count", "_pick")
    )
    single = F.col("candidate_count") == 1
    status = F.when(F.col("candidate_count") == 0, "unmatched").when(single, "matched").otherwise("ambiguous")

    def picked(name: str):
        return F.when(single, F.col(f"_pick.{name}"))

    return answered.select(
        "cancellation_nk",
        *columns,
        "candidate_count",
        status.alias("match_status"),
        picked("transaction_nk").alias("matched_transaction_nk"),
        picked("created_at").alias("matched_transaction_created_at"),
        picked("amount_tgrk").alias("matched_refund_amount_tgrk"),
        picked("currency").alias("matched_currency"),
        picked("is_test_user").alias("matched_is_test_user"),
        F.when(single, hours_crossed(F.col("_pick.created_at"), F.col("cancelled_at"))).alias("hours_to_cancel"),
        *lineage(run_ts),
    )
