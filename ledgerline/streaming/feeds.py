"""Messages to typed stream rows: parse once, route by source, drop what is unusable.

Every function takes and returns a DataFrame and works alike on batch and
streaming input. An arrival time may come with the message; else it is now.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions import fields
from ledgerline.functions.flags import flag, is_blank
from ledgerline.functions.keys import content_id
from ledgerline.functions.times import CANCEL_FORMAT, published_time, to_millis
from ledgerline.plans.staging import RATE_COLUMNS, quality_flags
from ledgerline.sources.schemas import MESSAGE

SOURCE = "kafka"


def parse_messages(messages: DataFrame, arrival: str | None = None) -> DataFrame:
    """Parse ``value`` into text columns and stamp the arrival time.

    The fields come out of a generator, so that each message is parsed once: a
    filter on plain struct fields would be pushed below the parse and repeat it
    per field.
    """
    stamp = F.col(arrival) if arrival else F.current_timestamp()
    message = F.from_json(F.col("value").cast("string"), MESSAGE)
    return messages.select(to_millis(stamp).alias("loaded_at"), F.inline(F.array(message)))


def _field(name: str) -> Column:
    return F.col(name)


def _routed(parsed: DataFrame, source: str) -> DataFrame:
    return parsed.where(_field("_source") == source)


def _tail() -> list[Column]:
    return [
        F.lit(SOURCE).alias("source"),
        F.col("loaded_at"),
        published_time(fields.text_or_null(_field("published_at"))).alias("published_at"),
    ]


def _usable(required: list[str], numbers: list[str]) -> Column:
    """Required whole numbers are there and no number is unreadable."""
    ok = F.lit(True)
    for name in required:
        ok = ok & fields.whole_number(_field(name)).isNotNull()
    for name in numbers:
        ok = ok & ~F.coalesce(fields.unreadable(_field(name)), F.lit(False))
    return ok


TRANSACTION_NUMBERS = ["amount", "user_id", "promo_code_id"]


def _transaction_ok() -> Column:
    return _usable(["transaction_id", "created_at"], TRANSACTION_NUMBERS)


def transactions(parsed: DataFrame) -> DataFrame:
    usable = _routed(parsed, "transaction").where(_transaction_ok())
    amount = fields.number_or_zero(_field("amount"))
    kind, status = fields.text_or_empty(_field("transaction_type")), fields.text_or_empty(_field("status"))
    user = fields.text_or_null(_field("user_uuid"))
    event_id = content_id(
        _field("transaction_id"),
        _field("created_at"),
        F.when(is_blank(_field("amount")), "0").otherwise(_field("amount")),
        _field("currency"),
        _field("transaction_type"),
        _field("status"),
        fields.text_or_null(_field("published_at")),
    )
    flags = quality_flags(user, amount, status, kind)
    return usable.select(
        event_id.alias("event_id"),
        fields.whole_number(_field("transaction_id")).alias("transaction_id"),
        fields.whole_number(_field("user_id")).alias("user_id"),
        user.alias("user_uuid"),
        amount.cast("double").alias("amount"),
        fields.text_or_empty(_field("currency")).alias("currency"),
        kind.alias("transaction_type"),
        fields.whole_number(_field("promo_code_id")).alias("promo_code_id"),
        status.alias("status"),
        F.timestamp_seconds(fields.whole_number(_field("created_at"))).alias("created_at"),
        *_tail(),
        F.lit(1).cast("bigint").alias("transaction_dup_rn"),
        F.lit(1).cast("bigint").alias("transaction_dup_cnt"),
        F.lit(0).alias("is_transaction_duplicate"),
        *[column.alias(name) for name, column in flags.items()],
    )


def _cancelled_at() -> Column:
    return F.try_to_timestamp(_field("cancelled_at"), F.lit(CANCEL_FORMAT))


def _cancellation_ok() -> Column:
    return _usable(["original_transaction_id"], ["refund_amount"]) & _cancelled_at().isNotNull()


def cancellations(parsed: DataFrame) -> DataFrame:
    usable = _routed(parsed, "cancellation").where(_cancellation_ok())
    refund = _field("refund_amount")
    event_id = content_id(
        _field("original_transaction_id"),
        _field("reason"),
        _field("cancelled_at"),
        F.when(is_blank(refund), "0").otherwise(refund),
        fields.text_or_null(_field("published_at")),
    )
    return usable.select(
        event_id.alias("event_id"),
        fields.whole_number(_field("original_transaction_id")).alias("original_transaction_id"),
        fields.text_or_empty(_field("reason")).alias("reason"),
        _cancelled_at().alias("cancelled_at"),
        fields.number_or_zero(refund).cast("double").alias("refund_amount"),
        *_tail(),
    )


def _rate_ok() -> Column:
    return _usable(["update_id", "timestamp"], [])


def exchange_rates(parsed: DataFrame) -> DataFrame:
    """Two rows per update, one per currency, in the fixed currency order.

    An unreadable rate ends the update there: it loses that currency and the
    later ones, the earlier ones stay.
    """
    usable = _routed(parsed, "exchange_rate").where(_rate_ok())
    rows, readable = [], F.lit(True)
    for currency, column in RATE_COLUMNS.items():
        readable = readable & ~F.coalesce(fields.unreadable(_field(column)), F.lit(False))
        rows.append(
            F.struct(
                F.lit(currency).alias("currency"),
                F.when(is_blank(_field(column)), "0").otherwise(_field(column)).alias("text"),
                fields.number_or_zero(_field(column)).cast("double").alias("rate"),
                readable.alias("ok"),
            )
        )
    tail = _tail()
    quoted = usable.withColumn("q", F.explode(F.array(*rows))).where("q.ok")
    event_id = content_id(
        _field("update_id"), _field("timestamp"), F.col("q.currency"), F.col("q.text"), tail[-1].cast("string")
    )
    return quoted.select(
        event_id.alias("event_id"),
        fields.whole_number(_field("update_id")).alias("update_id"),
        F.timestamp_seconds(fields.whole_number(_field("timestamp"))).alias("ts"),
        F.col("q.currency").alias("currency"),
        F.col("q.rate").alias("rate"),
        *tail,
    )


FEEDS = {
    "rt_transactions": transactions,
    "rt_cancellations": cancellations,
    "rt_exchange_rates": exchange_rates,
}


def observed(parsed: DataFrame, name: str = "feed_drops") -> DataFrame:
    """Count messages and drops as a side metric of whatever reads the result."""
    source = _field("_source")
    known = F.coalesce(source.isin("transaction", "cancellation", "exchange_rate"), F.lit(False))
    ok = (
        F.when(source == "transaction", _transaction_ok())
        .when(source == "cancellation", _cancellation_ok())
        .when(source == "exchange_rate", _rate_ok())
    )
    return parsed.observe(
        name,
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(flag(~known)), F.lit(0)).alias("unrouted"),
        F.coalesce(F.sum(flag(known & ~ok)), F.lit(0)).alias("dropped"),
    )
