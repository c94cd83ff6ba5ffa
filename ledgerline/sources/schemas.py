"""Declared schemas of raw, stream and log tables, with their sort keys.

A feed is read as text fields first (see loader); ``fields`` gives the type at
rest, and ``defaults`` the value a non-nullable column takes when a file omits it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


# Fixed value: load tasks that run side by side.
LOAD_TASKS = 20


@dataclass(frozen=True)
class Feed:
    """One family of JSON-lines files and the raw table it fills."""

    source_type: str
    table: str
    prefix: str
    suffix: str
    fields: dict[str, DataType]
    sort_key: list[str]
    nullable: list[str] = field(default_factory=list)
    files_per_task: int = 200

    @property
    def files_per_batch(self) -> int:
        """Files one Spark job loads: those of all load tasks together."""
        return self.files_per_task * LOAD_TASKS

    @property
    def text_schema(self) -> StructType:
        return StructType([StructField(name, StringType()) for name in self.fields])

    @property
    def defaults(self) -> dict[str, object]:
        zero = {LongType: 0, DoubleType: 0.0, StringType: "", BooleanType: False}
        return {n: zero[type(t)] for n, t in self.fields.items() if n not in self.nullable}


TRANSACTIONS = Feed(
    source_type="transactions",
    table="raw_transactions",
    prefix="",
    suffix="transactions.jsonl",
    fields={
        "transaction_id": LongType(),
        "user_id": LongType(),
        "user_uuid": StringType(),
        "amount": DoubleType(),
        "currency": StringType(),
        "transaction_type": StringType(),
        "promo_code_id": LongType(),
        "status": StringType(),
        "created_at": LongType(),
    },
    nullable=["user_id", "promo_code_id"],
    sort_key=["transaction_id"],
    files_per_task=200,
)

CANCELLATIONS = Feed(
    source_type="cancellations",
    table="raw_cancellations",
    prefix="cancellations/",
    suffix="cancellations.jsonl",
    fields={
        "cancellation_id": LongType(),
        "original_transaction_id": LongType(),
        "reason": StringType(),
        "cancelled_at": StringType(),
        "refund_amount": DoubleType(),
    },
    sort_key=["cancellation_id", "original_transaction_id"],
    files_per_task=50,
)

EXCHANGE_RATES = Feed(
    source_type="exchange_rates",
    table="raw_exchange_rates",
    prefix="exchange_rates/",
    suffix="rates.jsonl",
    fields={
        "update_id": LongType(),
        "timestamp": StringType(),
        "rate_tgrk_punk": DoubleType(),
        "rate_tgrk_rub": DoubleType(),
    },
    sort_key=["timestamp", "update_id"],
    files_per_task=50,
)

USERS = Feed(
    source_type="reference",
    table="raw_users",
    prefix="reference/users.jsonl",
    suffix="users.jsonl",
    fields={"user_id": LongType(), "user_uuid": StringType(), "is_test_user": BooleanType()},
    sort_key=["user_id"],
)

TEST_USERS = Feed(
    source_type="reference",
    table="raw_test_users",
    prefix="reference/test_users.jsonl",
    suffix="test_users.jsonl",
    fields={"test_user_uuid": StringType()},
    sort_key=["test_user_uuid"],
)

PROMO_CODES = Feed(
    source_type="reference",
    table="raw_promo_codes",
    prefix="reference/promo_codes.jsonl",
    suffix="promo_codes.jsonl",
    fields={
        "promo_code_id": LongType(),
        "code": StringType(),
        "max_uses": LongType(),
        "expiry_date": StringType(),
    },
    sort_key=["promo_code_id"],
)

FEEDS = [USERS, PROMO_CODES, TEST_USERS, TRANSACTIONS, CANCELLATIONS, EXCHANGE_RATES]


def raw_schema(feed: Feed) -> StructType:
    """Columns of the raw table, lineage included."""
    columns = [StructField(name, kind) for name, kind in feed.fields.items()]
    return StructType(columns + [StructField("source_file", StringType()), StructField("loaded_at", TimestampType())])


LOAD_LOG = StructType(
    [
        StructField("source_type", StringType()),
        StructField("source_file", StringType()),
        StructField("file_size", LongType()),
        StructField("loaded_rows", LongType()),
        StructField("status", StringType()),
        StructField("error_message", StringType()),
        StructField("started_at", TimestampType()),
        StructField("finished_at", TimestampType()),
        StructField("load_id", StringType()),
    ]
)

REJECTS = StructType(
    [
        StructField("source_type", StringType()),
        StructField("source_file", StringType()),
        StructField("line", StringType()),
        StructField("load_id", StringType()),
    ]
)

# Every field any stream message may carry, read as text.
MESSAGE = StructType(
    [
        StructField(name, StringType())
        for name in [
            "_source",
            "transaction_id",
            "created_at",
            "amount",
            "currency",
            "transaction_type",
            "status",
            "user_uuid",
            "user_id",
            "promo_code_id",
            "published_at",
            "original_transaction_id",
            "cancelled_at",
            "refund_amount",
            "reason",
            "update_id",
            "timestamp",
            "rate_tgrk_punk",
            "rate_tgrk_rub",
        ]
    ]
)

_STREAM_TAIL = [
    StructField("source", StringType()),
    StructField("loaded_at", TimestampType()),
    StructField("published_at", TimestampType()),
]

RT_TRANSACTIONS = StructType(
    [
        StructField("event_id", StringType()),
        StructField("transaction_id", LongType()),
        StructField("user_id", LongType()),
        StructField("user_uuid", StringType()),
        StructField("amount", DoubleType()),
        StructField("currency", StringType()),
        StructField("transaction_type", StringType()),
        StructField("promo_code_id", LongType()),
        StructField("status", StringType()),
        StructField("created_at", TimestampType()),
        *_STREAM_TAIL,
        StructField("transaction_dup_rn", LongType()),
        StructField("transaction_dup_cnt", LongType()),
        StructField("is_transaction_duplicate", IntegerType()),
        StructField("is_empty_user", IntegerType()),
        StructField("is_negative_amount", IntegerType()),
        StructField("is_zero_amount", IntegerType()),
        StructField("is_completed", IntegerType()),
        StructField("is_purchase", IntegerType()),
    ]
)

RT_CANCELLATIONS = StructType(
    [
        StructField("event_id", StringType()),
        StructField("original_transaction_id", LongType()),
        StructField("reason", StringType()),
        StructField("cancelled_at", TimestampType()),
        StructField("refund_amount", DoubleType()),
        *_STREAM_TAIL,
    ]
)

RT_EXCHANGE_RATES = StructType(
    [
        StructField("event_id", StringType()),
        StructField("update_id", LongType()),
        StructField("ts", TimestampType()),
        StructField("currency", StringType()),
        StructField("rate", DoubleType()),
        *_STREAM_TAIL,
    ]
)

# Stream tables with the key their latest row is kept by.
STREAM_TABLES = {
    "rt_transactions": (RT_TRANSACTIONS, ["created_at", "transaction_id", "event_id"]),
    "rt_cancellations": (RT_CANCELLATIONS, ["cancelled_at", "original_transaction_id", "event_id"]),
    "rt_exchange_rates": (RT_EXCHANGE_RATES, ["currency", "ts", "update_id", "event_id"]),
}
