"""The registered queries: each product over the given tables, with its SQL twin.

Both sides of a pair are cut to the same plain columns: times and dates as
text, counts as BIGINT, doubles rounded. Lineage times and hash keys stay out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.times import lenient_time
from ledgerline.operators import bitmaps
from ledgerline.operators.asof import asof_left_join
from ledgerline.operators.checks import CORE_CHECKS, run_checks
from ledgerline.operators.collisions import distinct_per
from ledgerline.operators.latest import latest_per_key
from ledgerline.plans import audit, dims, facts, marts, rolling, staging
from ledgerline.plans.rebuild import CORE, MARTS, STORED, Published, rebuild
from ledgerline.plans.refresh import DayStore, NewRows
from ledgerline.plans.views import register_stream
from ledgerline.plans.warehouse import Warehouse
from ledgerline.session import configure, scratch_folder, settle
from ledgerline.sources.loader import RawStore
from ledgerline.sources.schemas import (
    CANCELLATIONS,
    EXCHANGE_RATES,
    PROMO_CODES,
    STREAM_TABLES,
    TEST_USERS,
    TRANSACTIONS,
    USERS,
)
from ledgerline.streaming import feeds, live, sink, state
from ledgerline.trial import oracle, projection

AS_OF = datetime(2024, 1, 15, 12, 0, 0)
# Row groups of a file that a stream takes as one batch: as small as the least piece Spark cuts a file into, so that the batch
# is read and parsed by as many tasks as there are cores, not by one.
ARRIVING_ROW_GROUP = 4 * 1024 * 1024

# Column kinds: s as is, t text of a time or date, i BIGINT, n whole number or NULL
# (compared as DOUBLE, which has one form of NULL on either side), digits = rounded double.
Columns = dict[str, str]


def _columns(text: str) -> Columns:
    """Columns written as 'name:kind name:kind'."""
    return dict(part.split(":") for part in text.split())


COLUMNS: dict[str, Columns] = {
    "stg_transactions": _columns(
        "transaction_nk:s transaction_id:i user_id:i user_uuid:s amount:2 currency:s transaction_type:s promo_code_id:n "
        "status:s created_at:t source_file:s transaction_dup_rn:i transaction_dup_cnt:i is_transaction_duplicate:i "
        "is_empty_user:i is_negative_amount:i is_zero_amount:i is_completed:i is_purchase:i"
    ),
    "stg_cancellations": _columns(
        "cancellation_nk:s cancellation_id:i original_transaction_id:i reason:s cancelled_at:t refund_amount:2 source_file:s"
    ),
    "stg_exchange_rates": _columns("update_id:i ts:t currency:s rate:8"),
    "stg_users": _columns("user_id:i user_uuid:s is_test_user:i source_file:s"),
    "stg_promo_codes": _columns("promo_code_id:i code:s max_uses:i expiry_date:t source_file:s"),
    "dim_users": _columns("user_id:i user_uuid:s is_test_user:i source_file:s"),
    "dim_promo_codes": _columns("promo_code_id:i code:s max_uses:i expiry_date:t"),
    "dim_exchange_rates": _columns("update_id:i currency:s valid_from:t valid_to:t rate:8 is_current:i"),
    "fact_transactions": _columns(
        "transaction_nk:s transaction_id:i user_id:i user_uuid:s is_test_user:i is_unknown_user:i amount:2 currency:s "
        "exchange_rate:8 is_rate_missing:i amount_tgrk:6 transaction_type:s promo_code_id:n promo_code:s promo_max_uses:n "
        "promo_expiry_date:t status:s created_at:t is_empty_user:i is_negative_amount:i is_zero_amount:i is_completed:i "
        "is_purchase:i is_promo_used:i is_unknown_promo:i is_promo_expired:i"
    ),
    "fact_cancellations": _columns(
        "cancellation_nk:s cancellation_id:i original_transaction_id:i reason:s cancelled_at:t refund_amount:2"
    ),
    "fact_cancellation_matches": _columns(
        "cancellation_nk:s cancellation_id:i original_transaction_id:i reason:s cancelled_at:t refund_amount:2 "
        "candidate_count:i match_status:s matched_transaction_nk:s matched_transaction_created_at:t "
        "matched_refund_amount_tgrk:6 matched_currency:s matched_is_test_user:n hours_to_cancel:n"
    ),
    "dq_transactions_duplicate": _columns(
        "transaction_nk:s transaction_id:i user_id:i user_uuid:s amount:2 currency:s transaction_type:s promo_code_id:n "
        "status:s created_at:t transaction_dup_cnt:i is_transaction_duplicate:i"
    ),
    "mart_transactions_hourly": _columns(
        "created_hour:t transaction_type:s status:s currency:s is_test_user:i transaction_count:i purchase_type_count:i "
        "completed_count:i completed_purchase_count:i amount_original:2 amount_tgrk:4 negative_amount_count:i "
        "zero_amount_count:i missing_rate_count:i"
    ),
    "mart_purchases_hourly": _columns(
        "created_hour:t currency:s is_test_user:i purchase_count:i purchase_amount_original:2 purchase_amount_tgrk:4 "
        "avg_purchase_amount_tgrk:6 negative_purchase_count:i zero_purchase_count:i missing_rate_count:i"
    ),
    "mart_revenue_daily": _columns(
        "revenue_date:t is_test_user:i gross_revenue_tgrk:4 matched_refunds_tgrk:4 net_revenue_tgrk:4 purchase_count:i "
        "transaction_count:i missing_rate_count:i matched_cancellation_count:i ambiguous_cancellation_count:i "
        "unmatched_cancellation_count:i ambiguous_refund_amount_original:2 unmatched_refund_amount_original:2"
    ),
    "mart_promo_usage": _columns(
        "promo_code_id:i code:s max_uses:i real_uses:i is_test_user:n expiry_date:t uses_total:i uses_completed_purchase:i "
        "uses_expired:i usage_pct:6 is_limit_exceeded:i revenue_tgrk:4"
    ),
    "mart_traffic_source_daily": _columns(
        "event_date:t is_test_user:i transaction_count:i purchase_count:i gross_revenue_tgrk:4 matched_refunds_tgrk:4 "
        "net_revenue_tgrk:4 avg_purchase_amount_tgrk:6 matched_cancellation_count:i"
    ),
    "mart_currency_daily": _columns(
        "event_date:t currency:s transaction_count:i purchase_count:i total_amount_original:2 total_amount_tgrk:4 "
        "purchase_amount_original:2 purchase_amount_tgrk:4 avg_exchange_rate:6 missing_rate_count:i"
    ),
    "mart_cancellations_daily": _columns(
        "cancelled_date:t reason:s match_status:s cancellation_count:i refund_amount_original:2 "
        "matched_refund_amount_tgrk:4 avg_hours_to_cancel:6 purchase_count:i cancellation_rate:8"
    ),
    "mart_user_cohorts": _columns(
        "cohort_date:t activity_date:t days_since_cohort:i is_test_user:i users_count:i purchase_count:i revenue_tgrk:4"
    ),
    "mart_data_quality_daily": _columns(
        "event_date:t raw_transaction_rows:i clean_transaction_rows:i duplicate_transaction_rows:i "
        "duplicate_transaction_groups:i quarantined_duplicate_rows:i quarantined_duplicate_groups:i empty_user_rows:i "
        "negative_amount_rows:i zero_amount_rows:i duplicate_amount_original:2 unknown_user_rows:i unknown_promo_rows:i "
        "expired_promo_rows:i missing_rate_rows:i matched_cancellation_rows:i ambiguous_cancellation_rows:i "
        "unmatched_cancellation_rows:i"
    ),
    "rt_transactions": _columns(
        "transaction_id:i user_id:i user_uuid:s amount:2 currency:s transaction_type:s promo_code_id:n status:s "
        "created_at:t source:s loaded_at:t published_at:t transaction_dup_rn:i transaction_dup_cnt:i "
        "is_transaction_duplicate:i is_empty_user:i is_negative_amount:i is_zero_amount:i is_completed:i is_purchase:i"
    ),
    "rt_cancellations": _columns(
        "original_transaction_id:i reason:s cancelled_at:t refund_amount:2 source:s loaded_at:t published_at:t"
    ),
    "rt_exchange_rates": _columns("update_id:i ts:t currency:s rate:8 source:s loaded_at:t published_at:t"),
    "mart_rt_current_hour_metrics": _columns(
        "current_hour:t window_started_at:t calculated_at:t source:s transaction_count:i purchase_type_count:i "
        "completed_count:i completed_purchase_count:i currency:s amount_original:2 completed_purchase_amount_original:2 "
        "negative_amount_count:i zero_amount_count:i empty_user_count:i last_loaded_at:t"
    ),
    "mart_rt_events_per_minute": _columns("event_minute:t source:s event_type:s event_count:i"),
    "mart_rt_data_quality_last_60m": _columns(
        "window_started_at:t calculated_at:t source:s transaction_count:i empty_user_count:i negative_amount_count:i "
        "zero_amount_count:i duplicate_transaction_count:i empty_user_share:6 negative_amount_share:6 zero_amount_share:6"
    ),
}


def plain(df: DataFrame, columns: Columns) -> DataFrame:
    def cut(name: str, kind: str):
        value = F.col(name)
        if kind == "t":
            value = value.cast("string")
        elif kind in "in":
            value = value.cast("bigint" if kind == "i" else "double")
        elif kind != "s":
            value = F.round(value.cast("double"), int(kind))
        return value.alias(name)

    return df.select(*[cut(n, k) for n, k in columns.items()])


def plain_sql(source: str, columns: Columns) -> str:
    def cut(name: str, kind: str) -> str:
        if kind == "t":
            return f"CAST({name} AS VARCHAR) AS {name}"
        if kind in "in":
            return f"CAST({name} AS {'BIGINT' if kind == 'i' else 'DOUBLE'}) AS {name}"
        return name if kind == "s" else f"round(CAST({name} AS DOUBLE), {kind}) AS {name}"

    return f"SELECT {', '.join(cut(n, k) for n, k in columns.items())} FROM {source}"


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    configure(spark)
    return Warehouse(**vars(projection.raw_tables(spark, sf_dir)))


def _product(name: str) -> Entry:
    columns = COLUMNS[name]
    source = name
    if name == "dim_exchange_rates":
        source = (
            "(SELECT *, CASE WHEN valid_to = TIMESTAMP '2100-01-01 00:00:00' THEN 1 ELSE 0 END AS is_current "
            "FROM dim_exchange_rates)"
        )
    return Entry(
        lambda spark, sf_dir: plain(getattr(warehouse(spark, sf_dir), name), columns),
        oracle.batch(plain_sql(source, columns)),
    )


# Tables and marts in build order.
BATCH = [
    "stg_transactions",
    "stg_cancellations",
    "stg_exchange_rates",
    "stg_users",
    "stg_promo_codes",
    "dim_users",
    "dim_promo_codes",
    "dim_exchange_rates",
    "fact_transactions",
    "fact_cancellations",
    "fact_cancellation_matches",
    "dq_transactions_duplicate",
    "mart_transactions_hourly",
    "mart_purchases_hourly",
    "mart_revenue_daily",
    "mart_promo_usage",
    "mart_traffic_source_daily",
    "mart_currency_daily",
    "mart_cancellations_daily",
    "mart_user_cohorts",
    "mart_data_quality_daily",
]


# Stream tables and rolling views


def feed_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The stream tables by the batch form of the feeds, latest row per key."""
    configure(spark)
    parsed = feeds.parse_messages(projection.messages(spark, sf_dir), "arrived_at")
    return {name: sink.collapse(mapper(parsed), name) for name, mapper in feeds.FEEDS.items()}


def recent_feed_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """As above for the window before AS_OF: rows are filtered before they are collapsed."""
    configure(spark)
    parsed = feeds.parse_messages(projection.messages(spark, sf_dir), "arrived_at")
    return {
        name: sink.collapse(rolling.recent(mapper(parsed), AS_OF), name) for name, mapper in feeds.FEEDS.items()
    }


def stream_root(spark: SparkSession) -> str:
    return f"{scratch_folder(spark)}/streams/{uuid.uuid4().hex}"


def run_stream(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Run the streaming query over the events file to its end; return the table folder."""
    configure(spark)
    root = root or stream_root(spark)
    query = sink.start_feeds(
        projection.message_stream(spark, sf_dir), f"{root}/tables", f"{root}/checkpoint", "arrived_at", once=True
    )
    query.awaitTermination()
    return f"{root}/tables"


def _stateful(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The stream table as the state of a query over the events file holds it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        checkpoint = f"{stream_root(spark)}/checkpoint"
        state.keep_feed(projection.message_stream(spark, sf_dir), name, checkpoint, "arrived_at", once=True).awaitTermination()
        return plain(state.kept_table(spark, checkpoint, name), COLUMNS[name])

    return run


def _streamed(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain(sink.latest(spark, run_stream(spark, sf_dir), name), COLUMNS[name])


def _rt_current_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recent_feed_tables(spark, sf_dir)["rt_transactions"]
    return plain(rolling.current_hour_metrics(rows, AS_OF), COLUMNS["mart_rt_current_hour_metrics"])


def _rt_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.events_per_minute(*recent_feed_tables(spark, sf_dir).values(), AS_OF)


def _rt_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recent_feed_tables(spark, sf_dir)["rt_transactions"]
    return plain(rolling.data_quality(rows, AS_OF), COLUMNS["mart_rt_data_quality_last_60m"])


_PER_MINUTE = COLUMNS["mart_rt_events_per_minute"]


def _registered_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL view, registered before the first batch and read after the last."""
    configure(spark)
    root = stream_root(spark)
    register_stream(spark, f"{root}/tables", AS_OF)
    run_stream(spark, sf_dir, root)
    return plain(spark.sql("SELECT * FROM mart_rt_events_per_minute"), _PER_MINUTE)


def _registered_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    root = stream_root(spark)
    register_stream(spark, f"{root}/tables", AS_OF)
    run_stream(spark, sf_dir, root)
    return plain(spark.sql("SELECT * FROM mart_rt_data_quality_last_60m"), COLUMNS["mart_rt_data_quality_last_60m"])


def _live_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed streaming count over all messages, run to the end of the source."""
    configure(spark)
    root = f"{scratch_folder(spark)}/streams/{uuid.uuid4().hex}"
    parsed = feeds.parse_messages(projection.message_stream(spark, sf_dir), "arrived_at")
    kinds = {"transaction": feeds.transactions, "cancellation": feeds.cancellations, "exchange_rate": feeds.exchange_rates}
    counted = live.events_per_minute({kind: mapper(parsed) for kind, mapper in kinds.items()})
    writer = counted.writeStream.outputMode("append").format("parquet").trigger(availableNow=True)
    query = writer.option("checkpointLocation", f"{root}/checkpoint").start(f"{root}/minutes")
    query.awaitTermination()
    return plain(spark.read.schema(counted.schema).parquet(f"{root}/minutes"), _PER_MINUTE)


# Minutes the watermark has closed: they end 60 minutes or more before the last arrival.
_LIVE_SQL = """
arrived_rows AS (
    SELECT date_trunc('milliseconds', arrived) AS loaded_at,
           CASE event_type WHEN 'error' THEN 'cancellation' WHEN 'signup' THEN 'exchange_rate' ELSE 'transaction' END
               AS event_type,
           CASE WHEN event_type = 'signup' THEN CASE k WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 1 ELSE 2 END
                WHEN k IN (1, 2, 3) THEN 0 ELSE 1 END AS rows_made
    FROM arrivals
)"""


# Bulk


# Orders whose rate update gets a time far from all others.
_STRAY = "CASE o_orderkey % 5000 WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3786912000' END"


def _bulk_asof(spark: SparkSession, sf_dir: str, stray: bool = False, **options: int) -> DataFrame:
    """Every line item converted at the rate of its time; revenue per currency and ship month."""
    configure(spark)
    raw_rates = projection.bulk_exchange_rates(spark, sf_dir)
    if stray:
        moved = F.expr(_STRAY.replace("o_orderkey", "update_id"))
        raw_rates = raw_rates.withColumn("timestamp", F.coalesce(moved, "timestamp"))
    rates = settle(dims.exchange_rates(staging.exchange_rates(raw_rates)), "rates")
    paid = staging.keyed_transactions(projection.bulk_transactions(spark, sf_dir))
    rated = asof_left_join(
        paid, rates, "currency", "created_at", "valid_from", "valid_to", {"rate": "rate"}, "transaction_nk", **options
    )
    month = F.date_format("created_at", "yyyy-MM")
    return rated.groupBy("currency", month.alias("month")).agg(
        F.count(F.lit(1)).alias("payments"),
        F.count("rate").alias("rated"),
        F.round(F.sum("rate"), 7).alias("rate_sum"),
        F.round(F.sum(F.try_divide("amount", F.nullif(F.col("rate"), F.lit(0.0)))), 2).alias("amount_tgrk"),
    )


_BULK_ASOF_SQL = oracle.bulk(
    """SELECT p.currency, strftime(p.created_at, '%Y-%m') AS month, count(*) AS payments, count(r.rate) AS rated,
       round(sum(r.rate), 7) AS rate_sum, round(sum(p.amount / nullif(r.rate, 0)), 2) AS amount_tgrk
FROM payments p ASOF LEFT JOIN bulk_points r ON p.currency = r.currency AND p.created_at >= r.valid_from
GROUP BY ALL"""
)


_STRAY_ASOF_SQL = _BULK_ASOF_SQL.replace(
    "CAST(o_orderdate AS TIMESTAMP)",
    f"coalesce(make_timestamp(CAST({_STRAY} AS BIGINT) * 1000000), CAST(o_orderdate AS TIMESTAMP))",
)


def _bulk_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    flagged = staging.flagged_transactions(projection.bulk_transactions(spark, sf_dir))
    return plain(facts.quarantine(flagged), COLUMNS["dq_transactions_duplicate"])


def _bulk_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, colliding rows and colliding keys per ship month."""
    configure(spark)
    flagged = staging.flagged_transactions(projection.bulk_transactions(spark, sf_dir))
    duplicate = F.col("is_transaction_duplicate") == 1
    return distinct_per(
        flagged.withColumn("month", F.date_format("created_at", "yyyy-MM")),
        "month",
        F.when(duplicate, F.col("transaction_nk")),
        [F.count(F.lit(1)).alias("rows"), F.count_if(duplicate).alias("duplicates")],
        [F.sum("rows").alias("rows"), F.sum("duplicates").alias("duplicates")],
    )


_BULK_QUALITY_SQL = oracle.bulk(
    """SELECT strftime(created_at, '%Y-%m') AS month, count(*) AS rows,
       count(*) FILTER (is_transaction_duplicate = 1) AS duplicates,
       count(DISTINCT transaction_nk) FILTER (is_transaction_duplicate = 1) AS groups
FROM stg_transactions GROUP BY ALL"""
)


# Operators


def _latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event per user and type."""
    configure(spark)
    events = projection.table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    last = latest_per_key(events, ["user_id", "event_type"], "ts")
    return plain(last, _columns("user_id:i event_type:s ts:t event_id:i value:2"))


def _raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    raw = projection.raw_tables(spark, sf_dir)
    return audit.row_counts(
        {
            "raw_transactions": raw.transactions,
            "raw_cancellations": raw.cancellations,
            "raw_exchange_rates": raw.exchange_rates,
        }
    )


AUDITED_MARTS = ["mart_transactions_hourly", "mart_purchases_hourly", "mart_revenue_daily", "mart_promo_usage"]


def _mart_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = warehouse(spark, sf_dir)
    return audit.row_counts({name: getattr(built, name) for name in AUDITED_MARTS})


def _counts_sql(tables: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in tables)


CHECKED = [
    "dim_users",
    "dim_promo_codes",
    "dim_exchange_rates",
    "fact_transactions",
    "fact_cancellations",
    "fact_cancellation_matches",
]


def _column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and matches are checked as stored, since each check reads its table anew."""
    built = warehouse(spark, sf_dir)
    return run_checks({name: getattr(built, STORED.get(name, name)) for name in CHECKED})


def _checks_sql() -> str:
    # Surrogate keys have no twin in SQL; the columns they hash stand for them.
    stand_in = {"user_key": "user_uuid", "rate_key": "currency || valid_from"}
    lines = []
    for check in CORE_CHECKS:
        column = stand_in.get(check.column, check.column)
        if check.rule == "not_null":
            failures = f"SELECT count(*) FILTER ({column} IS NULL) FROM {check.table}"
        else:
            failures = (
                f"SELECT count(*) FROM (SELECT {column} AS v FROM {check.table} WHERE {column} IS NOT NULL "
                "GROUP BY 1 HAVING count(*) > 1)"
            )
        lines.append(
            f"SELECT '{check.table}' AS table_name, '{check.column}' AS column_name, '{check.rule}' AS rule, "
            f"({failures}) AS failures"
        )
    return oracle.batch(" UNION ALL ".join(lines))


# Orders whose rate update has a time that cannot be read.
_UNDATED = "CASE WHEN update_id % 700 = 3 THEN 'soon' ELSE `timestamp` END"
RATE_CHECKS = [c for c in CORE_CHECKS if c.table == "dim_exchange_rates"]


def _undated_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of the rate table when some updates have no readable time."""
    configure(spark)
    raw = projection.raw_tables(spark, sf_dir).exchange_rates.withColumn("timestamp", F.expr(_UNDATED))
    built = dims.exchange_rates(staging.exchange_rates(raw))
    return run_checks({"dim_exchange_rates": built}, RATE_CHECKS)


def _undated_sql() -> str:
    lost = "(SELECT 2 * count(*) FROM orders WHERE o_orderkey % 700 = 3)"
    # both currencies of an update share its time
    shared = """(SELECT 2 * count(*) FROM (SELECT 1 FROM orders WHERE o_orderkey % 700 <> 3
        GROUP BY (o_orderkey * 173) % 2592000 HAVING count(*) > 1))"""
    failures = {("currency", "not_null"): "0", ("rate_key", "unique"): shared}
    return " UNION ALL ".join(
        f"SELECT 'dim_exchange_rates' AS table_name, '{c.column}' AS column_name, '{c.rule}' AS rule, "
        f"CAST({failures.get((c.column, c.rule), lost)} AS BIGINT) AS failures"
        for c in RATE_CHECKS
    )


# Text forms that name a time without a zone, with the unit each of them ends at.
_FORMS = {
    "yyyy MMM dd HH:mm": "minute",
    "yyyy MMM dd HH:mm:ss": "second",
    "yyyy-MM-dd HH:mm:ss": "second",
    "yyyy-MM-dd HH:mm": "minute",
    "yyyy-MM-dd": "day",
    "yyyy-MM-dd'T'HH:mm:ss": "second",
    "dd MMM yyyy HH:mm:ss": "second",
    "dd MMM yyyy HH:mm": "minute",
    "yyyy/MM/dd HH:mm:ss": "second",
    "yyyy/MM/dd": "day",
    "dd/MM/yyyy HH:mm:ss": "second",
    "dd/MM/yyyy": "day",
    "yyyyMMddHHmmss": "second",
    "yyyyMMdd": "day",
}


def _time_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's time written in one of the known forms and read back."""
    configure(spark)
    events = projection.table(spark, sf_dir, "events")
    written = F.lit(None).cast("string")
    for i, form in enumerate(_FORMS):
        written = F.when(F.col("event_id") % len(_FORMS) == i, F.date_format("ts", form)).otherwise(written)
    read = lenient_time(written).cast("string").alias("read_back")
    return events.select(F.col("event_id").cast("bigint").alias("event_id"), read)


def _time_forms_sql() -> str:
    units = list(_FORMS.values())
    cases = " ".join(f"WHEN {i} THEN date_trunc('{u}', ts)" for i, u in enumerate(units))
    return f"""SELECT CAST(event_id AS BIGINT) AS event_id,
       strftime(CASE event_id % {len(units)} {cases} END, '%Y-%m-%d %H:%M:%S') AS read_back FROM events"""


_TIME_COLUMNS = _columns("event_id:i day_text:s hours:i minute_start:t next_day:t key:s")


def _scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, date and key functions over all events."""
    from ledgerline.functions.keys import content_id
    from ledgerline.functions.times import hours_crossed

    configure(spark)
    events = projection.table(spark, sf_dir, "events")
    rows = events.select(
        "event_id",
        F.replace(F.to_date("ts").cast("string"), F.lit("-"), F.lit("")).alias("day_text"),
        hours_crossed(F.col("ts"), F.col("ts") + F.expr("INTERVAL 100 MINUTES")).alias("hours"),
        F.date_trunc("minute", "ts").alias("minute_start"),
        F.date_add(F.to_date("ts"), 1).alias("next_day"),
        content_id(F.col("event_id"), F.nullif(F.col("event_type"), F.lit("view")), F.col("user_id")).alias("key"),
    )
    return plain(rows, _TIME_COLUMNS)


_SCALAR_SQL = f"""{plain_sql('''(
    SELECT event_id, replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', '') AS day_text,
           date_diff('hour', ts, ts + INTERVAL 100 MINUTE) AS hours, date_trunc('minute', ts) AS minute_start,
           CAST(ts AS DATE) + 1 AS next_day,
           md5(event_id || '|' || coalesce(nullif(event_type, 'view'), '') || '|' || user_id) AS key
    FROM events)''', _TIME_COLUMNS)}"""


# Ingestion


def write_inputs(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The raw tables as JSON-lines files, one folder per day where the rows have one."""
    raw = projection.raw_tables(spark, sf_dir)
    drop = ["source_file", "loaded_at"]

    def by_day(rows: DataFrame) -> DataFrame:
        return rows.withColumn("day", F.regexp_extract("source_file", "day=([^/]+)", 1)).drop(*drop).repartition("day")

    by_day(raw.transactions).write.partitionBy("day").json(f"{root}/transactions")
    by_day(raw.cancellations).write.partitionBy("day").json(f"{root}/cancellations")
    raw.exchange_rates.drop(*drop).write.json(f"{root}/exchange_rates")
    raw.users.drop(*drop).write.json(f"{root}/reference/users.jsonl")
    raw.test_users.drop(*drop).write.json(f"{root}/reference/test_users.jsonl")
    raw.promo_codes.drop(*drop).write.json(f"{root}/reference/promo_codes.jsonl")


# Spark names its own files, so the feeds are told apart by folder here.
WRITTEN_FEEDS = [
    replace(TRANSACTIONS, prefix="transactions/", suffix=".json"),
    replace(CANCELLATIONS, suffix=".json"),
    replace(EXCHANGE_RATES, suffix=".json"),
    replace(USERS, suffix=".json"),
    replace(TEST_USERS, suffix=".json"),
    replace(PROMO_CODES, suffix=".json"),
]


def _incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the written files twice: the second run finds nothing new."""
    configure(spark)
    root = f"{scratch_folder(spark)}/loads/{uuid.uuid4().hex}"
    write_inputs(spark, sf_dir, f"{root}/in")
    store = RawStore(spark, f"{root}/store")
    for _ in range(2):
        results = store.load_all(f"{root}/in", WRITTEN_FEEDS)
    again = {r.table: r.files for r in results}
    commits = store.commits()
    counts = audit.row_counts({feed.table: store.table(feed, commits) for feed in WRITTEN_FEEDS})
    reloaded = F.create_map(*[F.lit(x) for pair in again.items() for x in pair])
    return counts.withColumn("files_second_run", reloaded[F.col("table_name")].cast("bigint"))


RAW_NAMES = [
    "raw_transactions",
    "raw_cancellations",
    "raw_exchange_rates",
    "raw_users",
    "raw_test_users",
    "raw_promo_codes",
]


_LOADED = _columns(
    "transaction_id:i user_id:i user_uuid:s amount:2 currency:s transaction_type:s promo_code_id:n status:s created_at:i"
)


def _loaded_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the loader stores of the written transaction files, row by row."""
    configure(spark)
    root = f"{scratch_folder(spark)}/loads/{uuid.uuid4().hex}"
    write_inputs(spark, sf_dir, f"{root}/in")
    store = RawStore(spark, f"{root}/store")
    store.load(f"{root}/in", WRITTEN_FEEDS[0])
    return plain(store.table(WRITTEN_FEEDS[0]), _LOADED)


# Lines that are no single JSON object, made of an event's id.
_BAD_LINES = [
    """concat('{"transaction_id": ', event_id, '}{"transaction_id": 1}')""",
    """concat('{"transaction_id": ', event_id, '} trailing')""",
    """concat("{'transaction_id': ", event_id, '}')""",
    """concat('{"transaction_id": ', event_id)""",
    """concat('[', event_id, ']')""",
]


def _load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad lines among good ones: what is put aside, and what the log says of the files."""
    configure(spark)
    root = f"{scratch_folder(spark)}/loads/{uuid.uuid4().hex}"
    kinds = " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(_BAD_LINES))
    lines = projection.table(spark, sf_dir, "events").select(
        F.expr(f"""CASE event_id % 10 {kinds} ELSE concat('{{"transaction_id": ', event_id, ', "amount": 1}}') END""")
    )
    lines.write.text(f"{root}/in/transactions")
    store = RawStore(spark, f"{root}/store")
    store.load(f"{root}/in", replace(TRANSACTIONS, prefix="transactions/", suffix=".txt"))
    rejected = store.rejects().select("source_type", F.lit("rejected").alias("status"), "line")
    logged = store.load_log().groupBy("source_type", "status").agg(F.sum("loaded_rows").cast("string").alias("line"))
    return rejected.unionByName(logged)


def _rejects_sql() -> str:
    kinds = " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(_BAD_LINES)).replace('concat("{\'transaction_id\': "', "concat('{''transaction_id'': '")
    return f"""SELECT 'transactions' AS source_type, 'rejected' AS status, CASE event_id % 10 {kinds} END AS line
        FROM events WHERE event_id % 10 < {len(_BAD_LINES)}
        UNION ALL
        SELECT 'transactions', 'success', CAST(count(*) AS VARCHAR) FROM events WHERE event_id % 10 >= {len(_BAD_LINES)}"""


# Files by the type of their events: errors get an amount that is no number, which fails their file alone.
_MIXED = """concat('{"transaction_id": ', event_id, ', "amount": ', CASE event_type WHEN 'error' THEN '[1]' ELSE '1' END, '}')"""


def _load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says of a load of one file for each event type, one of them with values of the wrong type; loaded twice."""
    configure(spark)
    root = f"{scratch_folder(spark)}/loads/{uuid.uuid4().hex}"
    lines = projection.table(spark, sf_dir, "events").select("event_type", F.expr(_MIXED).alias("line"))
    lines.repartition("event_type").write.partitionBy("event_type").text(f"{root}/in/transactions")
    store = RawStore(spark, f"{root}/store")
    for _ in range(2):
        store.load(f"{root}/in", replace(TRANSACTIONS, prefix="transactions/", suffix=".txt"))
    kind = F.regexp_extract("source_file", "event_type=([^/]+)", 1)
    stored = store.table(TRANSACTIONS).groupBy(kind.alias("event_type")).agg(F.count(F.lit(1)).alias("stored_rows"))
    logged = store.load_log().groupBy(kind.alias("event_type"), "source_type", "status", "error_message").agg(
        F.count(F.lit(1)).alias("entries"), F.max("loaded_rows").alias("loaded_rows")
    )
    return logged.join(stored, "event_type", "left").withColumn("stored_rows", F.coalesce("stored_rows", F.lit(0)).cast("bigint"))


_LOAD_LOG_SQL = """SELECT event_type, 'transactions' AS source_type, CASE event_type WHEN 'error' THEN 'failed' ELSE 'success' END AS status,
       CASE event_type WHEN 'error' THEN 'value of the wrong type' ELSE '' END AS error_message,
       CAST(CASE event_type WHEN 'error' THEN 2 ELSE 1 END AS BIGINT) AS entries,
       CASE event_type WHEN 'error' THEN 0 ELSE count(*) END AS loaded_rows,
       CASE event_type WHEN 'error' THEN 0 ELSE count(*) END AS stored_rows
FROM events GROUP BY event_type"""


def _distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of the seven days up to each day, from bitmaps by day; the second half of the days came later."""
    configure(spark)
    rows = projection.transactions(spark, sf_dir).select(
        F.to_date(F.regexp_extract("source_file", "day=([^/]+)", 1)).alias("day"), "user_uuid"
    )
    early, late = rows.where("day <= DATE'2024-01-15'"), rows.where("day > DATE'2024-01-15'")
    numbers = bitmaps.number_keys(early, "user_uuid")
    stored = settle(bitmaps.day_bitmaps(early, "day", "user_uuid", numbers), "day-bitmaps")
    added = bitmaps.day_bitmaps(late, "day", "user_uuid", bitmaps.number_keys(late, "user_uuid", numbers))
    counted = bitmaps.sliding(stored.unionByName(settle(added, "day-bitmaps")), "day", 7, "users")
    return counted.select(F.col("until").cast("string").alias("until"), "users")


_DISTINCT_USERS_SQL = oracle.batch(
    """SELECT CAST(d.day AS VARCHAR) AS until, count(DISTINCT p.user_uuid) AS users
FROM (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day
      FROM (SELECT CAST(regexp_extract(source_file, 'day=([^/]+)', 1) AS DATE) AS day FROM raw_transactions)) d
JOIN (SELECT CAST(regexp_extract(source_file, 'day=([^/]+)', 1) AS DATE) AS day, user_uuid FROM raw_transactions) p
  ON p.day BETWEEN d.day - 6 AND d.day
GROUP BY 1"""
)


def _restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream run over half of the events, stopped, and started again when the other half is there."""
    configure(spark)
    root = stream_root(spark)
    events = projection.table(spark, sf_dir, "events")
    for half in range(2):
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{root}/events")
        arriving = spark.readStream.schema(events.schema).parquet(f"{root}/events")
        sink.start_feeds(
            projection.to_messages(arriving), f"{root}/tables", f"{root}/checkpoint", "arrived_at", once=True
        ).awaitTermination()
    stored = sink.read_table(spark, f"{root}/tables", "rt_transactions")
    return stored.agg(F.count(F.lit(1)).alias("stored_rows"), F.countDistinct("transaction_id").alias("transactions"))


def _compacted(name: str, read: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The stream run over the events in six batches, merged after three and after all of them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        root = stream_root(spark)
        events = projection.table(spark, sf_dir, "events")
        for half in range(2):
            batches = events.where(F.col("event_id") % 2 == half).repartition(3).write.option("parquet.block.size", ARRIVING_ROW_GROUP)
            batches.mode("append").parquet(f"{root}/events")
            arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/events")
            sink.start_feeds(
                projection.to_messages(arriving), f"{root}/tables", f"{root}/checkpoint", "arrived_at", once=True
            ).awaitTermination()
            sink.merge_batches(spark, f"{root}/tables")
        return plain(read(spark, f"{root}/tables"), COLUMNS[name])

    return run


def _merged_quality(spark: SparkSession, root: str) -> DataFrame:
    register_stream(spark, root, AS_OF)
    return spark.table("mart_rt_data_quality_last_60m")


# Every accepted arrival is stored once, those of messages that came twice both times.
_RESTARTED_SQL = """SELECT sum(CASE event_type WHEN 'purchase' THEN CASE WHEN k BETWEEN 10 AND 14 THEN 2 ELSE 1 END ELSE 1 END)::BIGINT AS stored_rows,
       count(*) AS transactions
FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
WHERE event_type NOT IN ('error', 'signup') AND coalesce(k, 0) NOT IN (1, 2, 3)"""


def _quality_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of the last hour as of now, of messages that arrived up to 88 minutes ago."""
    configure(spark)
    parsed = feeds.parse_messages(projection.messages(spark, sf_dir), "arrived_at")
    ago = F.make_interval(mins=(F.col("transaction_id") % 9 * 11).cast("int"))
    rows = feeds.transactions(parsed).withColumn("loaded_at", F.current_timestamp() - ago)
    now = sink.collapse(rolling.recent(rows, None), "rt_transactions")
    return plain(rolling.data_quality(now), _NOW_COLUMNS)


_NOW_COLUMNS = {n: k for n, k in COLUMNS["mart_rt_data_quality_last_60m"].items() if not n.endswith("_at")}
_QUALITY_NOW_SQL = f"""(SELECT 'kafka' AS source, transaction_count, empty_user_count, negative_amount_count, zero_amount_count,
       0 AS duplicate_transaction_count, empty_user_count / transaction_count AS empty_user_share,
       negative_amount_count / transaction_count AS negative_amount_share, zero_amount_count / transaction_count AS zero_amount_share
FROM (SELECT count(*) AS transaction_count, sum(is_empty_user) AS empty_user_count, sum(is_negative_amount) AS negative_amount_count,
             sum(is_zero_amount) AS zero_amount_count
      FROM rt_transactions WHERE transaction_id % 9 * 11 < 60))"""


def _lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source and time that every row of the built tables carries."""
    built = warehouse(spark, sf_dir)
    built.run_ts = AS_OF
    stamped = [
        getattr(built, name)
        .groupBy("source", F.col("loaded_at").cast("string").alias("loaded_at"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "source", "loaded_at", "rows")
        for name in STAMPED
    ]
    return reduce(DataFrame.unionByName, stamped)


STAMPED = ["dim_users", "dim_promo_codes", "dim_exchange_rates", "fact_cancellations", "dq_transactions_duplicate"]
_LINEAGE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'S3' AS source, '{AS_OF}' AS loaded_at, count(*) AS rows FROM {t}" for t in STAMPED
)


def _rt_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the stream tables before and after a rebuild, which ends with their clear."""
    root = run_stream(spark, sf_dir)
    before = audit.row_counts({t: sink.latest(spark, root, t) for t in STREAM_TABLES})
    before = settle(before.withColumnRenamed("rows", "rows_before"), "rt-before")
    published = Published(spark, f"{scratch_folder(spark)}/published/{uuid.uuid4().hex}")
    rebuild(warehouse(spark, sf_dir), published, root)
    after = audit.row_counts({t: sink.latest(spark, root, t) for t in STREAM_TABLES})
    return before.join(after.withColumnRenamed("rows", "rows_after"), "table_name")


_CLEAR_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_before, 0 AS rows_after FROM {t}" for t in STREAM_TABLES
)


def _rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build, check and publish every table; rows of each as published."""
    published = Published(spark, f"{scratch_folder(spark)}/published/{uuid.uuid4().hex}")
    rebuild(warehouse(spark, sf_dir), published)
    return audit.row_counts({name: published.table(name) for name in [*CORE, *MARTS]})


# What comes in late: the files of one day, cancellations of the next, and a quarter of a day's rates.
_LATE = {
    "transactions": "source_file LIKE '%day=2024-01-15%'",
    "cancellations": "source_file LIKE '%day=2024-01-16%'",
    "exchange_rates": "CAST(`timestamp` AS BIGINT) BETWEEN 1705708800 AND 1705730400",
}


def _in_two_steps(spark: SparkSession, sf_dir: str, feeds: list[str] | None = None) -> DayStore:
    """All raw rows taken in by two runs: the second gets the late ones, and rebuilds the days these touch."""
    configure(spark)
    raw = vars(projection.raw_tables(spark, sf_dir))
    given = {name: rows for name, rows in raw.items() if feeds is None or name in feeds}
    late = {name: rows.where(_LATE[name]) for name, rows in given.items() if name in _LATE}
    early = {name: rows.where(f"NOT coalesce({_LATE[name]}, false)") if name in _LATE else rows for name, rows in given.items()}
    store = DayStore(spark, f"{scratch_folder(spark)}/days/{uuid.uuid4().hex}")
    store.refresh(NewRows(**early))
    store.refresh(NewRows(**late))
    return store


def _two_steps(name: str, feeds: list[str] | None = None) -> Entry:
    return Entry(
        lambda spark, sf_dir: plain(_in_two_steps(spark, sf_dir, feeds).read(name), COLUMNS[name]), _product(name).sql
    )


def entries() -> dict[str, Entry]:
    found = {name: _product(name) for name in BATCH}
    for name in STREAM_TABLES:
        sql = oracle.stream(plain_sql(name, COLUMNS[name]))
        found[name] = Entry(
            lambda spark, sf_dir, name=name: plain(feed_tables(spark, sf_dir)[name], COLUMNS[name]), sql
        )
        found[f"streamed_{name}"] = Entry(_streamed(name), sql)
        found[f"stateful_{name}"] = Entry(_stateful(name), sql)

    def rolling_sql(name: str) -> str:
        return oracle.stream(plain_sql(name, COLUMNS[name]))

    found["mart_rt_current_hour_metrics"] = Entry(_rt_current_hour, rolling_sql("mart_rt_current_hour_metrics"))
    found["mart_rt_events_per_minute"] = Entry(
        lambda spark, sf_dir: plain(_rt_per_minute(spark, sf_dir), _PER_MINUTE),
        rolling_sql("mart_rt_events_per_minute"),
    )
    found["mart_rt_data_quality_last_60m"] = Entry(_rt_quality, rolling_sql("mart_rt_data_quality_last_60m"))
    found["top_minutes"] = Entry(
        lambda spark, sf_dir: plain(rolling.top_minutes(_rt_per_minute(spark, sf_dir)), _PER_MINUTE),
        oracle.stream(
            plain_sql(
                "(SELECT * FROM mart_rt_events_per_minute ORDER BY event_minute DESC, source, event_type LIMIT 10)",
                _PER_MINUTE,
            )
        ),
    )
    found["live_events_per_minute"] = Entry(
        _live_per_minute,
        oracle.chain(
            plain_sql(
                """(SELECT date_trunc('minute', loaded_at) AS event_minute, 'kafka' AS source, event_type,
                           sum(rows_made) AS event_count
                    FROM arrived_rows WHERE rows_made > 0
                      AND date_trunc('minute', loaded_at) + INTERVAL 1 MINUTE
                          <= (SELECT max(loaded_at) FROM arrived_rows WHERE rows_made > 0) - INTERVAL 60 MINUTE
                    GROUP BY ALL)""",
                _PER_MINUTE,
            ),
            oracle.STREAM,
            _LIVE_SQL,
        ),
    )
    found["asof_bulk_lineitem"] = Entry(_bulk_asof, _BULK_ASOF_SQL)
    found["asof_bulk_lineitem_shuffled"] = Entry(
        lambda spark, sf_dir: _bulk_asof(spark, sf_dir, broadcast_rows=0), _BULK_ASOF_SQL
    )
    found["asof_stray_rates"] = Entry(
        lambda spark, sf_dir: _bulk_asof(spark, sf_dir, stray=True, broadcast_rows=0), _STRAY_ASOF_SQL
    )
    found["quarantine_bulk_lineitem"] = Entry(
        _bulk_quarantine,
        oracle.bulk(
            plain_sql(
                "(SELECT * FROM stg_transactions WHERE is_transaction_duplicate = 1)",
                COLUMNS["dq_transactions_duplicate"],
            )
        ),
    )
    found["collision_counts_bulk_lineitem"] = Entry(_bulk_quality, _BULK_QUALITY_SQL)
    found["latest_by_key"] = Entry(
        _latest_by_key,
        """SELECT user_id, event_type, CAST(max(ts) AS VARCHAR) AS ts, arg_max(event_id, ts) AS event_id,
       round(arg_max(value, ts), 2) AS value FROM events GROUP BY user_id, event_type""",
    )
    found["raw_row_counts"] = Entry(_raw_counts, oracle.batch(_counts_sql(RAW_NAMES[:3])))
    found["mart_row_counts"] = Entry(_mart_counts, oracle.batch(_counts_sql(AUDITED_MARTS)))
    found["column_checks"] = Entry(_column_checks, _checks_sql())
    found["rebuild_row_counts"] = Entry(_rebuild, oracle.batch(_counts_sql([*CORE, *MARTS])))
    found["rebuild_touched_days"] = _two_steps("mart_revenue_daily")
    found["touched_days_matches"] = _two_steps("fact_cancellation_matches")
    found["touched_days_quality"] = _two_steps("mart_data_quality_daily")
    found["touched_days_cohorts"] = _two_steps("mart_user_cohorts")
    found["spliced_exchange_rates"] = _two_steps("dim_exchange_rates", ["exchange_rates"])
    found["load_log_rows"] = Entry(_load_log, _LOAD_LOG_SQL)
    found["compacted_rt_transactions"] = Entry(
        _compacted("rt_transactions", lambda spark, root: sink.latest(spark, root, "rt_transactions")),
        oracle.stream(plain_sql("rt_transactions", COLUMNS["rt_transactions"])),
    )
    found["compacted_rt_quality"] = Entry(
        _compacted("mart_rt_data_quality_last_60m", _merged_quality), rolling_sql("mart_rt_data_quality_last_60m")
    )
    found["stream_restarted"] = Entry(_restarted, _RESTARTED_SQL)
    found["rt_quality_as_of_now"] = Entry(_quality_now, oracle.stream(plain_sql(_QUALITY_NOW_SQL, _NOW_COLUMNS)))
    found["distinct_users_of_weeks"] = Entry(_distinct_users, _DISTINCT_USERS_SQL)
    found["lineage_of_tables"] = Entry(_lineage, oracle.batch(_LINEAGE_SQL))
    found["scalar_functions"] = Entry(_scalar_functions, _SCALAR_SQL)
    found["incremental_load"] = Entry(
        _incremental_load,
        oracle.batch(f"SELECT *, CAST(0 AS BIGINT) AS files_second_run FROM ({_counts_sql(RAW_NAMES)})"),
    )
    found["loaded_raw_transactions"] = Entry(
        _loaded_transactions, oracle.batch(plain_sql("raw_transactions", _LOADED))
    )
    found["load_rejects"] = Entry(_load_rejects, _rejects_sql())
    found["undated_rates_gate"] = Entry(_undated_rates, _undated_sql())
    found["time_forms"] = Entry(_time_forms, _time_forms_sql())
    found["registered_rt_views"] = Entry(_registered_per_minute, rolling_sql("mart_rt_events_per_minute"))
    found["registered_rt_quality"] = Entry(_registered_quality, rolling_sql("mart_rt_data_quality_last_60m"))
    found["rt_clear_after_rebuild"] = Entry(_rt_clear, oracle.stream(_CLEAR_SQL))
    return found
