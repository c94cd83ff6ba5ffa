"""Raw payment tables derived from the given tables, whole tables each.

The formulas plant every defect the plans handle: colliding ids, slot-dated
rows, unknown currencies, blank, unknown and test-only users, bad amounts,
unknown and expired promos, zero rates, unreadable cancellation dates, and
purchases posted again in the next slot. ``oracle`` states the same in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class RawTables:
    transactions: DataFrame
    cancellations: DataFrame
    exchange_rates: DataFrame
    users: DataFrame
    test_users: DataFrame
    promo_codes: DataFrame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its zoneless timestamps are read as UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def _loaded() -> list:
    return [F.lit("2024-02-01 00:00:00").cast("timestamp").alias("loaded_at")]


def _payment_columns() -> dict[str, str]:
    return {
        "transaction_id": "event_id - CASE WHEN event_id % 97 = 1 THEN 1 ELSE 0 END",
        "amount": """CASE WHEN event_id % 50 = 0 THEN 0 WHEN event_id % 41 = 0 THEN 0 - value ELSE value END""",
        "currency": """CASE WHEN event_id % 44 = 3 THEN 'ZZZ' WHEN event_id % 4 = 1 THEN 'PUNK'
                       WHEN event_id % 4 = 2 THEN 'RUB' ELSE 'TGRK' END""",
        "user_uuid": """CASE WHEN event_id % 23 = 0 THEN '' WHEN event_id % 29 = 0 THEN concat('x', user_id)
                        WHEN event_id % 31 = 0 THEN concat('t', user_id % 10) ELSE concat('u', user_id) END""",
        "promo_code_id": """CASE WHEN event_id % 6 = 0 THEN event_id % 35
                            WHEN event_id % 143 = 0 THEN 1000000000 + event_id END""",
        "status": "CASE WHEN event_id % 5 = 0 THEN 'failed' ELSE 'completed' END",
        "created_at": "CASE WHEN event_id % 101 = 0 THEN 0 ELSE unix_seconds(ts) END",
    }


def posted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, and again 30 minutes later those purchases whose property k is below 5."""
    events = table(spark, sf_dir, "events")
    again = (F.col("event_type") == "purchase") & (F.get_json_object("props", "$.k").cast("int") < 5)
    times = F.when(again, F.array("ts", F.expr("ts + INTERVAL 30 MINUTES"))).otherwise(F.array("ts"))
    return events.withColumn("ts", F.explode(times))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    formulas = _payment_columns()
    half_hour = "CASE WHEN minute(ts) < 30 THEN '00' ELSE '30' END"
    return posted_events(spark, sf_dir).select(
        F.expr(formulas["transaction_id"]).alias("transaction_id"),
        "user_id",
        F.expr(formulas["user_uuid"]).alias("user_uuid"),
        F.expr(formulas["amount"]).cast("double").alias("amount"),
        F.expr(formulas["currency"]).alias("currency"),
        F.col("event_type").alias("transaction_type"),
        F.expr(formulas["promo_code_id"]).alias("promo_code_id"),
        F.expr(formulas["status"]).alias("status"),
        F.expr(formulas["created_at"]).alias("created_at"),
        F.expr(
            "concat('transactions/day=', date_format(ts, 'yyyy-MM-dd'), '/slot=', date_format(ts, 'HH'), '-', "
            f"{half_hour}, '/transactions.jsonl')"
        ).alias("source_file"),
        *_loaded(),
    )


def cancellations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per event: refunds of purchases and signups fit their transaction, the others are off by 1."""
    formulas = _payment_columns()
    cancelled = """CASE WHEN event_id % 70 = 0 THEN 'bad date'
        WHEN event_id % 14 = 0 THEN date_format(ts + INTERVAL 2 DAYS, 'yyyy MMM dd HH:mm')
        ELSE date_format(ts + INTERVAL 1 DAY, 'yyyy MMM dd HH:mm') END"""
    refund = f"0 - ({formulas['amount']}) - CASE WHEN event_type IN ('purchase', 'signup') THEN 0 ELSE 1 END"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("cancellation_id"),
        F.expr(formulas["transaction_id"]).alias("original_transaction_id"),
        F.expr("CASE event_id % 3 WHEN 0 THEN 'fraud' WHEN 1 THEN 'mistake' ELSE 'other' END").alias("reason"),
        F.expr(cancelled).alias("cancelled_at"),
        F.expr(refund).cast("double").alias("refund_amount"),
        F.expr("concat('cancellations/day=', date_format(ts, 'yyyy-MM-dd'), '/cancellations.jsonl')").alias(
            "source_file"
        ),
        *_loaded(),
    )


def exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update per order, scattered over 30 days from one hour after the first event."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("update_id"),
        F.expr("cast(1704070800 + (o_orderkey * 173) % 2592000 as string)").alias("timestamp"),
        F.expr("CASE WHEN o_orderkey % 500 = 1 THEN 0 ELSE 10 + o_totalprice / 100000 END")
        .cast("double")
        .alias("rate_tgrk_punk"),
        F.expr("50 + o_totalprice / 10000").cast("double").alias("rate_tgrk_rub"),
        F.lit("exchange_rates/rates.jsonl").alias("source_file"),
        *_loaded(),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.expr("concat('u', c_custkey)").alias("user_uuid"),
        F.expr("c_custkey % 20 = 0").alias("is_test_user"),
        F.lit("reference/users.jsonl").alias("source_file"),
        *_loaded(),
    )


def test_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other supplier repeats a user, the rest are on the test list only."""
    return table(spark, sf_dir, "supplier").select(
        F.expr("concat(CASE WHEN s_suppkey % 2 = 0 THEN 'u' ELSE 't' END, s_suppkey)").alias("test_user_uuid"),
        F.lit("reference/test_users.jsonl").alias("source_file"),
        *_loaded(),
    )


def promo_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    expiry = """CASE WHEN p_partkey % 17 = 5 THEN 'never'
        ELSE date_format(date_add(DATE'2024-01-01', cast(p_partkey % 40 as int)), 'yyyy-MM-dd') END"""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("promo_code_id"),
        F.expr("concat('P', p_partkey)").alias("code"),
        F.expr("CASE WHEN p_partkey % 10 = 0 THEN 0 ELSE p_size END").cast("bigint").alias("max_uses"),
        F.expr(expiry).alias("expiry_date"),
        F.lit("reference/promo_codes.jsonl").alias("source_file"),
        *_loaded(),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        transactions(spark, sf_dir),
        cancellations(spark, sf_dir),
        exchange_rates(spark, sf_dir),
        users(spark, sf_dir),
        test_users(spark, sf_dir),
        promo_codes(spark, sf_dir),
    )


def bulk_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a payment of one single slot, so that repeated ids collide."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("l_orderkey * 10 + l_linenumber").alias("transaction_id"),
        F.col("l_suppkey").alias("user_id"),
        F.expr("concat('u', l_suppkey)").alias("user_uuid"),
        F.col("l_extendedprice").alias("amount"),
        F.expr("CASE l_returnflag WHEN 'A' THEN 'TGRK' WHEN 'N' THEN 'PUNK' ELSE 'RUB' END").alias("currency"),
        F.lit("purchase").alias("transaction_type"),
        F.expr("CASE WHEN l_discount > 0.05 THEN l_partkey END").alias("promo_code_id"),
        F.expr("CASE l_linestatus WHEN 'F' THEN 'completed' ELSE 'failed' END").alias("status"),
        F.expr("unix_seconds(l_shipdate) + l_partkey % 86400").alias("created_at"),
        F.lit("transactions/day=2024-01-01/slot=00-00/transactions.jsonl").alias("source_file"),
        *_loaded(),
    )


def bulk_exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update per order at midnight of its date: many updates share a time."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("update_id"),
        F.expr("cast(unix_seconds(o_orderdate) as string)").alias("timestamp"),
        F.expr("10 + o_totalprice / 100000").alias("rate_tgrk_punk"),
        F.expr("50 + o_totalprice / 10000").alias("rate_tgrk_rub"),
        F.lit("exchange_rates/rates.jsonl").alias("source_file"),
        *_loaded(),
    )


def to_messages(events: DataFrame) -> DataFrame:
    """Every event as one JSON message with its arrival time.

    Purchases, views and clicks become transactions, errors cancellations and
    signups rate updates. Property k plants the defects: 1 broken JSON, 2 a
    missing or unreadable time, 3 an unreadable number, 4 a missing number, 5 an
    unreadable publish time; purchases with k from 10 to 14 arrive twice.
    """
    k = "cast(get_json_object(props, '$.k') as int)"
    sources = """CASE event_type WHEN 'error' THEN 'cancellation' WHEN 'signup' THEN 'exchange_rate'
                 ELSE 'transaction' END"""
    published = "date_format(ts - INTERVAL 5 SECONDS, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    number = "CASE k WHEN 3 THEN 'n/a' WHEN 4 THEN NULL ELSE cast({} as string) END"
    known = events.withColumn("k", F.expr(k))
    twice = (F.col("event_type") == "purchase") & F.col("k").between(10, 14)
    arrivals = F.when(twice, F.array("ts", F.expr("ts + INTERVAL 30 MINUTES"))).otherwise(F.array("ts"))
    body = known.withColumn("arrived_at", F.explode(arrivals)).select(
        "arrived_at",
        "k",
        F.expr(sources).alias("_source"),
        F.col("event_id").alias("transaction_id"),
        F.expr("CASE k WHEN 2 THEN NULL ELSE unix_seconds(ts) END").alias("created_at"),
        F.expr(number.format("CASE WHEN event_id % 41 = 0 THEN 0 - value ELSE value END")).alias("amount"),
        F.expr("CASE event_id % 4 WHEN 1 THEN 'PUNK' WHEN 2 THEN 'RUB' ELSE 'TGRK' END").alias("currency"),
        F.col("event_type").alias("transaction_type"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN 'failed' ELSE 'completed' END").alias("status"),
        F.expr("CASE WHEN event_id % 23 = 0 THEN '  ' ELSE concat('u', user_id) END").alias("user_uuid"),
        "user_id",
        F.expr("CASE WHEN event_id % 6 = 0 THEN event_id % 35 END").alias("promo_code_id"),
        F.expr(f"CASE k WHEN 5 THEN 'yesterday' ELSE {published} END").alias("published_at"),
        F.col("event_id").alias("original_transaction_id"),
        F.expr("CASE k WHEN 2 THEN 'bad date' ELSE date_format(ts, 'yyyy MMM dd HH:mm') END").alias("cancelled_at"),
        F.expr(number.format("0 - value")).alias("refund_amount"),
        F.expr("CASE event_id % 3 WHEN 0 THEN 'fraud' WHEN 1 THEN 'mistake' ELSE 'other' END").alias("reason"),
        F.col("event_id").alias("update_id"),
        F.expr("CASE k WHEN 2 THEN NULL ELSE unix_seconds(ts) END").alias("timestamp"),
        F.expr("10 + value / 100").alias("rate_tgrk_punk"),
        F.expr(number.format("50 + value / 10")).alias("rate_tgrk_rub"),
    )
    fields = [c for c in body.columns if c not in ("arrived_at", "k")]
    text = F.to_json(F.struct(*fields))
    broken = F.lit('{"_source": "transaction", ')
    return body.select(F.when(F.col("k") == 1, broken).otherwise(text).alias("value"), "arrived_at")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_messages(table(spark, sf_dir, "events"))


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as an unbounded source over the events file."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return to_messages(stream.withColumn("ts", F.col("ts").cast("timestamp")))
