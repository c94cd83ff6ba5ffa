"""Batch marts.

Seven of the nine marts are sums over the same few columns of the fact, so they
share one pass: ``hourly_activity`` reduces the fact to one row per hour, type,
status, currency and test flag, and the marts fold that small table. Averages
travel as sum and count. Only promo usage and cohorts read the fact again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.functions.flags import flag, sum_if, sum_if_or_zero
from ledgerline.operators.collisions import distinct_per
from ledgerline.operators.combine import combine

CELL = ["created_hour", "transaction_type", "status", "currency", "is_test_user"]
BOUGHT = "is_purchase = 1 AND is_completed = 1"


def bought() -> Column:
    return F.expr(BOUGHT)


def hourly_activity(fact: DataFrame) -> DataFrame:
    """Counts and sums of the fact per hour, type, status, currency and test flag."""
    rated = F.col("is_rate_missing") == 0
    return fact.groupBy(
        F.date_trunc("hour", "created_at").alias("created_hour"), "transaction_type", "status", "currency", "is_test_user"
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("is_purchase") == 1).alias("purchase_types"),
        F.count_if(F.col("is_completed") == 1).alias("completed"),
        F.count_if(bought()).alias("purchases"),
        F.sum("amount").alias("amount"),
        F.sum("amount_tgrk").alias("amount_tgrk"),
        sum_if(F.col("amount"), bought()).alias("purchase_amount"),
        sum_if(F.col("amount_tgrk"), bought()).alias("purchase_amount_tgrk"),
        F.count(F.when(bought(), F.col("amount_tgrk"))).alias("purchases_converted"),
        F.count_if(F.col("is_negative_amount") == 1).alias("negative"),
        F.count_if(F.col("is_zero_amount") == 1).alias("zero"),
        F.count_if(~rated).alias("rate_missing"),
        sum_if(F.col("exchange_rate"), rated).alias("rate_sum"),
        F.count(F.when(rated, F.col("exchange_rate"))).alias("rate_count"),
        F.count_if(F.col("is_unknown_user") == 1).alias("unknown_user"),
        F.count_if(F.col("is_unknown_promo") == 1).alias("unknown_promo"),
        F.count_if(F.col("is_promo_expired") == 1).alias("promo_expired"),
    )


def transactions_hourly(activity: DataFrame) -> DataFrame:
    return activity.select(
        *CELL,
        F.col("rows").alias("transaction_count"),
        F.col("purchase_types").alias("purchase_type_count"),
        F.col("completed").alias("completed_count"),
        F.col("purchases").alias("completed_purchase_count"),
        F.col("amount").alias("amount_original"),
        "amount_tgrk",
        F.col("negative").alias("negative_amount_count"),
        F.col("zero").alias("zero_amount_count"),
        F.col("rate_missing").alias("missing_rate_count"),
    )


def purchases_hourly(activity: DataFrame) -> DataFrame:
    """Type and status are fixed by the filter, so whole cells are purchases."""
    cells = activity.where((F.col("transaction_type") == "purchase") & (F.col("status") == "completed"))
    return cells.select(
        "created_hour",
        "currency",
        "is_test_user",
        F.col("rows").alias("purchase_count"),
        F.col("amount").alias("purchase_amount_original"),
        F.col("amount_tgrk").alias("purchase_amount_tgrk"),
        F.try_divide("amount_tgrk", F.col("purchases_converted")).alias("avg_purchase_amount_tgrk"),
        F.col("negative").alias("negative_purchase_count"),
        F.col("zero").alias("zero_purchase_count"),
        F.col("rate_missing").alias("missing_rate_count"),
    )


def _daily(activity: DataFrame, day: str, by: str):
    return activity.groupBy(F.to_date("created_hour").alias(day), by)


def _cancelled_daily(matches: DataFrame, day: str) -> DataFrame:
    """Refunds per day and test flag; a refund without a match counts as a real user's."""
    status = F.col("match_status")
    refund, refund_tgrk = F.abs("refund_amount"), F.abs("matched_refund_amount_tgrk")
    return (
        matches.where("cancelled_at IS NOT NULL")
        .groupBy(
            F.to_date("cancelled_at").alias(day), F.coalesce("matched_is_test_user", F.lit(0)).alias("is_test_user")
        )
        .agg(
            sum_if(refund_tgrk, status == "matched").alias("matched_refunds_tgrk"),
            F.count_if(status == "matched").alias("matched_cancellation_count"),
            F.count_if(status == "ambiguous").alias("ambiguous_cancellation_count"),
            F.count_if(status == "unmatched").alias("unmatched_cancellation_count"),
            sum_if(refund, status == "ambiguous").alias("ambiguous_refund_amount_original"),
            sum_if(refund, status == "unmatched").alias("unmatched_refund_amount_original"),
        )
    )


def _zero(name: str, zero: float | int = 0) -> Column:
    return F.coalesce(name, F.lit(zero)).alias(name)


def revenue_daily(activity: DataFrame, matches: DataFrame) -> DataFrame:
    """Gross, refunds and net per day and test flag, days of either side; gaps are 0."""
    sold = _daily(activity, "revenue_date", "is_test_user").agg(
        F.sum("purchase_amount_tgrk").alias("gross_revenue_tgrk"),
        F.sum("purchases").alias("purchase_count"),
        F.sum("rows").alias("transaction_count"),
        F.sum("rate_missing").alias("missing_rate_count"),
    )
    refunded = _cancelled_daily(matches, "revenue_date")
    amounts = [
        "gross_revenue_tgrk",
        "matched_refunds_tgrk",
        "ambiguous_refund_amount_original",
        "unmatched_refund_amount_original",
    ]
    counts = [
        "purchase_count",
        "transaction_count",
        "missing_rate_count",
        "matched_cancellation_count",
        "ambiguous_cancellation_count",
        "unmatched_cancellation_count",
    ]
    both = combine([sold, refunded], ["revenue_date", "is_test_user"], amounts + counts).withColumns(
        {**{a: F.coalesce(a, F.lit(0.0)) for a in amounts}, **{c: F.coalesce(c, F.lit(0)) for c in counts}}
    )
    return both.select(
        "revenue_date",
        "is_test_user",
        "gross_revenue_tgrk",
        "matched_refunds_tgrk",
        (F.col("gross_revenue_tgrk") - F.col("matched_refunds_tgrk")).alias("net_revenue_tgrk"),
        *counts,
        *amounts[2:],
    )


def traffic_source_daily(activity: DataFrame, matches: DataFrame) -> DataFrame:
    """Test against real users on days that have transactions."""
    traffic = _daily(activity, "event_date", "is_test_user").agg(
        F.sum("rows").alias("transaction_count"),
        F.sum("purchases").alias("purchase_count"),
        F.sum("purchase_amount_tgrk").alias("gross_revenue_tgrk"),
        F.sum("purchases_converted").alias("_converted"),
    )
    refunded = _cancelled_daily(matches, "event_date").select(
        "event_date", "is_test_user", "matched_refunds_tgrk", "matched_cancellation_count"
    )
    refunds = F.coalesce("matched_refunds_tgrk", F.lit(0.0))
    return traffic.join(refunded, ["event_date", "is_test_user"], "left").select(
        "event_date",
        "is_test_user",
        "transaction_count",
        "purchase_count",
        "gross_revenue_tgrk",
        refunds.alias("matched_refunds_tgrk"),
        (F.col("gross_revenue_tgrk") - refunds).alias("net_revenue_tgrk"),
        F.try_divide("gross_revenue_tgrk", F.col("_converted")).alias("avg_purchase_amount_tgrk"),
        _zero("matched_cancellation_count"),
    )


def currency_daily(activity: DataFrame) -> DataFrame:
    return (
        _daily(activity, "event_date", "currency")
        .agg(
            F.sum("rows").alias("transaction_count"),
            F.sum("purchases").alias("purchase_count"),
            F.sum("amount").alias("total_amount_original"),
            F.sum("amount_tgrk").alias("total_amount_tgrk"),
            F.coalesce(F.sum("purchase_amount"), F.lit(0.0)).alias("purchase_amount_original"),
            F.sum("purchase_amount_tgrk").alias("purchase_amount_tgrk"),
            F.try_divide(F.sum("rate_sum"), F.sum("rate_count")).alias("avg_exchange_rate"),
            F.sum("rate_missing").alias("missing_rate_count"),
        )
    )


def cancellations_daily(activity: DataFrame, matches: DataFrame) -> DataFrame:
    """Cancellations per day, reason and status against the purchases of that day."""
    matched = F.col("match_status") == "matched"
    cancelled = (
        matches.where("cancelled_at IS NOT NULL")
        .groupBy(F.to_date("cancelled_at").alias("cancelled_date"), "reason", "match_status")
        .agg(
            F.count(F.lit(1)).alias("cancellation_count"),
            F.sum(F.abs("refund_amount")).alias("refund_amount_original"),
            sum_if(F.abs("matched_refund_amount_tgrk"), matched).alias("matched_refund_amount_tgrk"),
            F.avg(F.when(matched, F.col("hours_to_cancel"))).alias("avg_hours_to_cancel"),
        )
    )
    purchases = activity.groupBy(F.to_date("created_hour").alias("cancelled_date")).agg(
        F.sum("purchases").alias("purchase_count")
    )
    return cancelled.join(purchases, "cancelled_date", "left").select(
        "cancelled_date",
        "reason",
        "match_status",
        "cancellation_count",
        "refund_amount_original",
        "matched_refund_amount_tgrk",
        "avg_hours_to_cancel",
        _zero("purchase_count"),
        F.try_divide("cancellation_count", F.col("purchase_count")).alias("cancellation_rate"),
    )


def promo_uses(fact: DataFrame, *by: str) -> DataFrame:
    """Counts and revenue per promo and test flag, and per ``by`` if given: sums that can be summed again."""
    return (
        fact.where("promo_code_id IS NOT NULL")
        .groupBy("promo_code_id", "is_test_user", *by)
        .agg(
            F.count(F.lit(1)).alias("uses_total"),
            F.count_if(bought()).alias("uses_completed_purchase"),
            F.count_if(F.col("is_promo_expired") == 1).alias("uses_expired"),
            sum_if(F.col("amount_tgrk"), bought()).alias("revenue_tgrk"),
        )
    )


def promo_usage(promos: DataFrame, fact: DataFrame) -> DataFrame:
    """Use of every promo by test flag; an unused promo has 0 uses and no flag."""
    return promo_usage_of(promos, promo_uses(fact))


def promo_usage_of(promos: DataFrame, used: DataFrame) -> DataFrame:
    """The same from the sums of each promo and test flag."""
    kept = promos.select("promo_code_id", "code", "max_uses", "expiry_date").join(used, "promo_code_id", "left")
    kept = kept.withColumns({c: _zero(c) for c in ["uses_total", "uses_completed_purchase", "uses_expired"]})
    kept = kept.withColumn("real_uses", F.col("uses_total") - F.col("uses_expired"))
    limit = F.greatest("max_uses", "real_uses")
    return kept.select(
        "promo_code_id",
        "code",
        "max_uses",
        "real_uses",
        "is_test_user",
        "expiry_date",
        "uses_total",
        "uses_completed_purchase",
        "uses_expired",
        F.when(F.col("max_uses") != 0, F.try_divide("uses_completed_purchase", limit)).alias("usage_pct"),
        flag(F.col("uses_completed_purchase") > F.col("max_uses")).alias("is_limit_exceeded"),
        "revenue_tgrk",
    )


def user_days(fact: DataFrame) -> DataFrame:
    """Purchases of each user by day and test flag."""
    return (
        fact.where(bought() & F.col("user_uuid").isNotNull())
        .groupBy("user_uuid", F.to_date("created_at").alias("activity_date"), "is_test_user")
        .agg(F.count(F.lit(1)).alias("_purchases"), F.sum("amount_tgrk").alias("_revenue"))
    )


def user_cohorts(fact: DataFrame) -> DataFrame:
    """Activity of users by the day of their first purchase.

    Purchases shrink to one row per user, day and test flag before anything is
    grouped by user alone, so the busiest user costs one row per active day.
    """
    first = F.min("activity_date").over(Window.partitionBy("user_uuid"))
    return cohorts_of(user_days(fact).withColumn("cohort_date", first))


def cohorts_of(active: DataFrame) -> DataFrame:
    """The same from the days of users and the ``cohort_date`` of each."""
    return (
        active.groupBy("cohort_date", "activity_date", "is_test_user")
        .agg(
            F.count(F.lit(1)).alias("users_count"),
            F.sum("_purchases").alias("purchase_count"),
            F.sum("_revenue").alias("revenue_tgrk"),
        )
        .select(
            "cohort_date",
            "activity_date",
            F.datediff("activity_date", "cohort_date").alias("days_since_cohort"),
            "is_test_user",
            "users_count",
            "purchase_count",
            "revenue_tgrk",
        )
    )


def data_quality_daily(
    flagged: DataFrame, quarantined: DataFrame, activity: DataFrame, matches: DataFrame
) -> DataFrame:
    """Row counts by defect per day, days of any source; gaps are 0."""
    return quality_of(staged_quality(flagged), quarantined, activity, matches)


def staged_quality(flagged: DataFrame) -> DataFrame:
    """The counts of the staged rows of each day.

    Rows without a collision collapse to one key per day before the shuffle.
    """
    duplicate = F.col("is_transaction_duplicate") == 1
    return distinct_per(
        flagged.withColumn("event_date", F.to_date("created_at")),
        "event_date",
        F.when(duplicate, F.col("transaction_nk")),
        [
            F.count(F.lit(1)).alias("raw_transaction_rows"),
            F.count_if(~duplicate).alias("clean_transaction_rows"),
            F.count_if(duplicate).alias("duplicate_transaction_rows"),
            F.sum("is_empty_user").alias("empty_user_rows"),
            F.sum("is_negative_amount").alias("negative_amount_rows"),
            F.sum("is_zero_amount").alias("zero_amount_rows"),
            sum_if_or_zero(F.col("amount"), duplicate).alias("duplicate_amount_original"),
        ],
        [
            F.sum(c).alias(c)
            for c in [
                "raw_transaction_rows",
                "clean_transaction_rows",
                "duplicate_transaction_rows",
                "empty_user_rows",
                "negative_amount_rows",
                "zero_amount_rows",
                "duplicate_amount_original",
            ]
        ],
    ).withColumnRenamed("groups", "duplicate_transaction_groups")


def quality_of(staged: DataFrame, quarantined: DataFrame, activity: DataFrame, matches: DataFrame) -> DataFrame:
    """The quality mart from the counts of the staged rows and the other sources."""
    held = distinct_per(
        quarantined.withColumn("event_date", F.to_date("created_at")),
        "event_date",
        F.col("transaction_nk"),
        [F.count(F.lit(1)).alias("quarantined_duplicate_rows")],
        [F.sum("quarantined_duplicate_rows").alias("quarantined_duplicate_rows")],
    ).withColumnRenamed("groups", "quarantined_duplicate_groups")
    facts = activity.groupBy(F.to_date("created_hour").alias("event_date")).agg(
        F.sum("unknown_user").alias("unknown_user_rows"),
        F.sum("unknown_promo").alias("unknown_promo_rows"),
        F.sum("promo_expired").alias("expired_promo_rows"),
        F.sum("rate_missing").alias("missing_rate_rows"),
    )
    status = F.col("match_status")
    cancelled = (
        matches.where("cancelled_at IS NOT NULL")
        .groupBy(F.to_date("cancelled_at").alias("event_date"))
        .agg(
            F.count_if(status == "matched").alias("matched_cancellation_rows"),
            F.count_if(status == "ambiguous").alias("ambiguous_cancellation_rows"),
            F.count_if(status == "unmatched").alias("unmatched_cancellation_rows"),
        )
    )
    columns = [
        "raw_transaction_rows",
        "clean_transaction_rows",
        "duplicate_transaction_rows",
        "duplicate_transaction_groups",
        "quarantined_duplicate_rows",
        "quarantined_duplicate_groups",
        "empty_user_rows",
        "negative_amount_rows",
        "zero_amount_rows",
        "duplicate_amount_original",
        "unknown_user_rows",
        "unknown_promo_rows",
        "expired_promo_rows",
        "missing_rate_rows",
        "matched_cancellation_rows",
        "ambiguous_cancellation_rows",
        "unmatched_cancellation_rows",
    ]
    return combine([staged, held, facts, cancelled], ["event_date"], columns).select(
        "event_date", *[_zero(c) for c in columns]
    )
