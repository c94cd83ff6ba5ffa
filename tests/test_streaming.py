"""Feeds, stream tables, rolling views: batch and streaming forms on the same messages."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import rolling
from ledgerline.sources.messages import file_messages, topic_options
from ledgerline.streaming import feeds, live, sink

AT = 1704438489  # 2024-01-05 07:08:09 UTC
WHEN = datetime(2024, 1, 5, 7, 8, 9)


def tx(**change):
    base = {
        "_source": "transaction",
        "transaction_id": 7,
        "created_at": AT,
        "amount": 12.5,
        "currency": "RUB",
        "transaction_type": "purchase",
        "status": "completed",
        "user_uuid": "u1",
        "user_id": 1,
        "promo_code_id": None,
        "published_at": "2024-01-05T07:08:10Z",
    }
    return json.dumps({k: v for k, v in {**base, **change}.items() if v != "absent"})


def parsed(spark, *values, arrival=WHEN):
    return feeds.parse_messages(spark.createDataFrame([(v, arrival) for v in values], "value string, at timestamp"), "at")


def test_transaction_fields(spark):
    row = feeds.transactions(parsed(spark, tx())).first()
    assert (row.transaction_id, row.amount, row.currency, row.promo_code_id) == (7, 12.5, "RUB", None)
    assert (row.created_at, row.loaded_at, row.published_at) == (WHEN, WHEN, WHEN + timedelta(seconds=1))
    assert (row.source, row.transaction_dup_rn, row.transaction_dup_cnt, row.is_transaction_duplicate) == ("kafka", 1, 1, 0)
    assert (row.is_empty_user, row.is_negative_amount, row.is_zero_amount, row.is_completed, row.is_purchase) == (0, 0, 0, 1, 1)


def test_numbers_as_text_and_missing_values(spark):
    values = [
        tx(transaction_id="7", created_at=str(AT), amount="-3.5", user_uuid="  ", status="absent"),
        tx(transaction_id=8, amount="absent"),
        tx(transaction_id=9.9, amount=None, user_uuid="absent"),
    ]
    columns = ["transaction_id", "amount", "user_uuid", "status", "is_empty_user", "is_negative_amount", "is_zero_amount"]
    got = sorted(tuple(r) for r in feeds.transactions(parsed(spark, *values)).select(*columns).collect())
    assert got == [
        (7, -3.5, None, "", 1, 1, 0),
        (8, 0.0, "u1", "completed", 0, 0, 1),
        (9, 0.0, None, "completed", 1, 0, 1),
    ]


@pytest.mark.parametrize(
    "value",
    [
        "{broken",
        "[1, 2]",
        "",
        tx(created_at=None),
        tx(created_at="absent"),
        tx(transaction_id=" "),
        tx(amount="n/a"),
        tx(user_id="n/a"),
        tx(_source="cancellation"),
        tx(_source="other"),
    ],
)
def test_unusable_transactions_are_dropped(spark, value):
    assert feeds.transactions(parsed(spark, value)).count() == 0


def test_event_id_is_stable_and_covers_the_publish_time(spark):
    ids = [r.event_id for r in feeds.transactions(parsed(spark, tx(), tx(user_uuid="u2"), tx(published_at="x"))).collect()]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 32


def test_cancellations(spark):
    def cancel(**change):
        base = {"_source": "cancellation", "original_transaction_id": 7, "cancelled_at": "2024 Jan 06 01:02"}
        return json.dumps({**base, "refund_amount": "-2.5", "reason": "fraud", **change})

    values = [cancel(), cancel(cancelled_at="06.01.2024"), cancel(original_transaction_id=None), cancel(refund_amount="x")]
    got = feeds.cancellations(parsed(spark, *values)).collect()
    assert [(r.original_transaction_id, r.cancelled_at, r.refund_amount, r.reason, r.published_at) for r in got] == [
        (7, datetime(2024, 1, 6, 1, 2), -2.5, "fraud", None)
    ]


def test_rates_make_two_rows(spark):
    def rate(**change):
        return json.dumps({"_source": "exchange_rate", "update_id": 3, "timestamp": AT, "rate_tgrk_punk": 2, **change})

    values = [rate(rate_tgrk_rub=5.5), rate(update_id=4), rate(update_id=5, rate_tgrk_rub="x"), rate(update_id=None)]
    got = feeds.exchange_rates(parsed(spark, *values)).select("update_id", "currency", "rate").collect()
    # A bad second rate leaves the first one in place.
    assert sorted(tuple(r) for r in got) == [
        (3, "PUNK", 2.0),
        (3, "RUB", 5.5),
        (4, "PUNK", 2.0),
        (4, "RUB", 0.0),
        (5, "PUNK", 2.0),
    ]


@pytest.fixture
def stream(spark, tmp_path, write_lines):
    class Stream:
        inbox, root, checkpoint = f"{tmp_path}/in", f"{tmp_path}/tables", f"{tmp_path}/checkpoint"

        def send(self, name, *values):
            write_lines(f"{self.inbox}/{name}.txt", values)

        def run(self):
            query = sink.start_feeds(file_messages(spark, self.inbox), self.root, self.checkpoint, once=True)
            query.awaitTermination()
            return query

    return Stream()


def test_stream_restart_loads_each_message_once(spark, stream):
    stream.send("a", tx(), tx(transaction_id=8), "junk")
    query = stream.run()
    drops = [p.observedMetrics["feed_drops"] for p in query.recentProgress if "feed_drops" in p.observedMetrics]
    assert [(d.messages, d.unrouted, d.dropped) for d in drops] == [(3, 1, 0)]
    stream.run()
    assert sink.read_table(spark, stream.root, "rt_transactions").count() == 2
    stream.send("b", tx(transaction_id=9), tx(amount="x"))
    stream.run()
    assert sorted(r.transaction_id for r in sink.latest(spark, stream.root, "rt_transactions").collect()) == [7, 8, 9]


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    batch = parsed(spark, tx(), tx(transaction_id=8))
    for _ in range(2):
        sink.write_feeds(batch, 0, str(tmp_path))
    assert sink.read_table(spark, str(tmp_path), "rt_transactions").count() == 2


def test_another_query_does_not_overwrite(spark, tmp_path, write_lines):
    root = f"{tmp_path}/tables"
    for name, value in (("a", tx()), ("b", tx(transaction_id=8))):
        write_lines(f"{tmp_path}/{name}/m.txt", [value])
        messages = file_messages(spark, f"{tmp_path}/{name}")
        sink.start_feeds(messages, root, f"{tmp_path}/checkpoint-{name}", once=True).awaitTermination()
    assert sorted(r.transaction_id for r in sink.read_table(spark, root, "rt_transactions").collect()) == [7, 8]


def test_latest_row_per_key(spark, tmp_path):
    sink.write_feeds(parsed(spark, tx(user_uuid="old")), 0, str(tmp_path))
    sink.write_feeds(parsed(spark, tx(user_uuid="new"), arrival=WHEN + timedelta(minutes=5)), 1, str(tmp_path))
    got = sink.latest(spark, str(tmp_path), "rt_transactions").collect()
    assert [(r.user_uuid, r.loaded_at) for r in got] == [("new", WHEN + timedelta(minutes=5))]


def test_clear_keeps_batches_above_the_mark(spark, tmp_path):
    root = str(tmp_path)
    sink.write_feeds(parsed(spark, tx()), 0, root)
    mark = sink.high_water(spark, root)
    sink.write_feeds(parsed(spark, tx(transaction_id=8)), 1, root)
    sink.clear_tables(spark, root, through=mark)
    assert [r.transaction_id for r in sink.read_table(spark, root, "rt_transactions").collect()] == [8]
    sink.clear_tables(spark, root)
    assert sink.read_table(spark, root, "rt_transactions").count() == 0 and sink.high_water(spark, root) == -1


def test_rolling_window_edges(spark):
    now = WHEN + timedelta(hours=1)
    base = feeds.transactions(parsed(spark, tx()))
    times = [now - timedelta(minutes=60), now - timedelta(minutes=60, seconds=1), now, now + timedelta(seconds=1)]
    rows = base.withColumn("loaded_at", F.explode(F.array(*[F.lit(t) for t in times])))
    row = rolling.current_hour_metrics(rows, now).first()
    assert (row.transaction_count, row.amount_original, row.last_loaded_at) == (2, 25.0, now)
    assert (row.current_hour, row.window_started_at) == (datetime(2024, 1, 5, 8), now - timedelta(minutes=60))


def test_quality_of_an_empty_window_is_one_row_of_zeros(spark):
    row = rolling.data_quality(feeds.transactions(parsed(spark, tx())), WHEN + timedelta(days=1)).first()
    assert (row.transaction_count, row.empty_user_share, row.zero_amount_share) == (0, 0.0, 0.0)


def test_top_minutes(spark):
    rows = feeds.transactions(parsed(spark, tx())).withColumn(
        "loaded_at", F.explode(F.array(*[F.lit(WHEN + timedelta(minutes=i)) for i in range(15)]))
    )
    empty = rows.limit(0)
    minutes = rolling.events_per_minute(rows, empty, empty, WHEN + timedelta(minutes=20))
    got = [r.event_minute for r in rolling.top_minutes(minutes).collect()]
    assert got == [datetime(2024, 1, 5, 7, 8) + timedelta(minutes=i) for i in range(14, 4, -1)]


def test_streaming_dedup_keeps_one_row_per_event(spark, stream, tmp_path):
    stream.send("a", tx(), tx(), tx(transaction_id=8))
    rows = feeds.transactions(feeds.parse_messages(file_messages(spark, stream.inbox)))
    writer = live.first_per_event(rows).writeStream.format("parquet").trigger(availableNow=True)
    writer.option("checkpointLocation", f"{tmp_path}/c").start(f"{tmp_path}/out").awaitTermination()
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [7, 8]


def test_topic_options():
    options = topic_options("host:9092", "payments", "group", per_trigger=500)
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "500"
    assert topic_options("h", "t", "g", "Earliest-Offset")["startingOffsets"] == "earliest"
