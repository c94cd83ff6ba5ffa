"""Loading files, and the whole way from files to published tables."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.checks import STOPPING, CheckFailure, require, run_checks
from ledgerline.plans.rebuild import CORE, MARTS, Published, rebuild, warehouse_of
from ledgerline.plans.views import register_published, register_raw, register_staging, register_stream
from ledgerline.sources.loader import RawStore
from ledgerline.sources.schemas import CANCELLATIONS, EXCHANGE_RATES, FEEDS, PROMO_CODES, TEST_USERS, TRANSACTIONS, USERS
from ledgerline.streaming import feeds, sink

DAY = 1704067200


def tx(id, **change):
    base = {"transaction_id": id, "user_id": 1, "user_uuid": "u1", "amount": 10.0, "currency": "RUB"}
    return {**base, "transaction_type": "purchase", "promo_code_id": None, "status": "completed", "created_at": DAY + 3600, **change}


def slot(root, name):
    return f"{root}/in/transactions/day=2024-01-01/slot={name}/transactions.jsonl"


@pytest.fixture
def store(spark, tmp_path):
    return RawStore(spark, f"{tmp_path}/store")


@pytest.fixture
def load(store, tmp_path):
    return lambda feed, **options: store.load(f"{tmp_path}/in", feed, **options)


def test_load_and_skip(store, load, write_lines, tmp_path, rows):
    write_lines(slot(tmp_path, "01-00"), [tx(1), tx(2, amount="7.5", created_at=str(DAY))])
    write_lines(slot(tmp_path, "01-30"), [tx(1)])
    assert load(TRANSACTIONS).files == 2
    path = "transactions/day=2024-01-01/slot=01-00/transactions.jsonl"
    got = rows(store.table(TRANSACTIONS), "transaction_id", "amount", "created_at", "source_file")
    assert got[2] == (2, 7.5, DAY, path) and len(got) == 3
    again = load(TRANSACTIONS)
    assert (again.files, store.table(TRANSACTIONS).count(), store.load_log().count()) == (0, 3, 2)
    log = rows(store.load_log().where(F.col("source_file") == path), "source_type", "loaded_rows", "status", "error_message")
    assert log == [("transactions", 2, "success", "")]
    size = store.load_log().where(F.col("source_file") == path).first()["file_size"]
    assert size == len(open(slot(tmp_path, "01-00")).read())


def test_broken_lines_do_not_fail_the_file(store, load, write_lines, tmp_path, rows):
    write_lines(slot(tmp_path, "01-00"), [tx(1), "{broken", "", "[1]", "   ", "null", tx(2)])
    assert load(TRANSACTIONS).failed_files == 0
    assert rows(store.table(TRANSACTIONS), "transaction_id") == [(1,), (2,)]
    assert rows(store.rejects(), "line") == [("   ",), ("[1]",), ("null",), ("{broken",)]
    assert rows(store.load_log(), "loaded_rows", "status") == [(2, "success")]


def test_a_wrong_type_fails_its_file_only_and_is_retried(store, load, write_lines, tmp_path, rows):
    write_lines(slot(tmp_path, "01-00"), [tx(1), tx(2, amount="abc")])
    write_lines(slot(tmp_path, "01-30"), [tx(3)])
    assert load(TRANSACTIONS).failed_files == 1
    assert rows(store.table(TRANSACTIONS), "transaction_id") == [(3,)]
    assert rows(store.load_log(), "loaded_rows", "status") == [(0, "failed"), (1, "success")]
    write_lines(slot(tmp_path, "01-00"), [tx(1), tx(2)])
    assert load(TRANSACTIONS).files == 1
    assert rows(store.table(TRANSACTIONS), "transaction_id") == [(1,), (2,), (3,)]


def test_missing_values_take_column_defaults(store, load, write_lines, tmp_path, rows):
    write_lines(slot(tmp_path, "01-00"), [{"transaction_id": 5, "extra": 1}])
    load(TRANSACTIONS)
    columns = ["user_id", "user_uuid", "amount", "currency", "promo_code_id", "created_at"]
    assert rows(store.table(TRANSACTIONS), *columns) == [(None, "", 0.0, "", None, 0)]


def test_small_batches_load_everything(store, load, write_lines, tmp_path):
    for i in range(7):
        write_lines(slot(tmp_path, f"0{i}-00"), [tx(i)])
    assert load(TRANSACTIONS, files_per_batch=2).files == 7
    assert store.table(TRANSACTIONS).count() == 7 and store.load_log().count() == 7


def test_a_crash_is_logged_and_leaves_nothing_visible(store, load, write_lines, tmp_path, rows, monkeypatch):
    write_lines(slot(tmp_path, "01-00"), [tx(1)])

    def crash(*args):
        raise OSError("disk gone")

    monkeypatch.setattr(RawStore, "_write_log", crash)
    with pytest.raises(OSError):
        load(TRANSACTIONS)
    monkeypatch.undo()
    assert store.table(TRANSACTIONS).count() == 0
    assert rows(store.load_log(), "loaded_rows", "status", "error_message") == [(0, "failed", "disk gone")]
    assert load(TRANSACTIONS).files == 1 and store.table(TRANSACTIONS).count() == 1


def test_feeds_do_not_mix(store, load, write_lines, tmp_path):
    root = f"{tmp_path}/in"
    write_lines(slot(tmp_path, "01-00"), [tx(1)])
    write_lines(f"{root}/cancellations/day=2024-01-02/cancellations.jsonl", [{"cancellation_id": 1}])
    write_lines(f"{root}/elsewhere/cancellations.jsonl", [{"cancellation_id": 2}])
    write_lines(f"{root}/exchange_rates/rates.jsonl", [{"update_id": 1, "timestamp": DAY}])
    write_lines(f"{root}/reference/users.jsonl", [{"user_id": 1, "user_uuid": "u1", "is_test_user": False}])
    write_lines(f"{root}/reference/test_users.jsonl", [{"test_user_uuid": "t1"}])
    write_lines(f"{root}/reference/promo_codes.jsonl", [{"promo_code_id": 1, "max_uses": 0}])
    counts = {r.table: r.files for r in store.load_all(root)}
    assert counts == {feed.table: 1 for feed in FEEDS}
    assert store.table(EXCHANGE_RATES).first()["timestamp"] == str(DAY)
    assert store.table(USERS).first()["is_test_user"] is False
    assert store.table(CANCELLATIONS).first()["cancellation_id"] == 1


@pytest.fixture
def loaded(store, write_lines, tmp_path):
    root = f"{tmp_path}/in"
    write_lines(slot(tmp_path, "01-00"), [tx(1), tx(2), tx(2), tx(3, created_at=0, promo_code_id=1)])
    write_lines(slot(tmp_path, "01-30"), [tx(4, currency="TGRK", user_uuid="t1")])
    write_lines(
        f"{root}/cancellations/day=2024-01-02/cancellations.jsonl",
        [{"cancellation_id": 1, "original_transaction_id": 1, "reason": "x", "cancelled_at": "2024 Jan 02 05:00", "refund_amount": -10}],
    )
    write_lines(f"{root}/exchange_rates/rates.jsonl", [{"update_id": 1, "timestamp": DAY, "rate_tgrk_punk": 2, "rate_tgrk_rub": 4}])
    write_lines(f"{root}/reference/users.jsonl", [{"user_id": 1, "user_uuid": "u1", "is_test_user": False}])
    write_lines(f"{root}/reference/test_users.jsonl", [{"test_user_uuid": "t1"}])
    write_lines(f"{root}/reference/promo_codes.jsonl", [{"promo_code_id": 1, "code": "A", "max_uses": 1, "expiry_date": "2024-05-01"}])
    store.load_all(root)
    return store


def send(spark, root, batch_id, id):
    value = json.dumps({"_source": "transaction", **tx(id)})
    messages = spark.createDataFrame([(value, datetime(2024, 1, 5, 7, 8, 9))], "value string, at timestamp")
    sink.write_feeds(feeds.parse_messages(messages, "at"), batch_id, root)


def test_files_to_published_tables(spark, loaded, tmp_path, rows):
    published = Published(spark, f"{tmp_path}/out")
    stream_root = f"{tmp_path}/stream"
    send(spark, stream_root, 0, 9)
    first = rebuild(warehouse_of(loaded, datetime(2024, 2, 1)), published, stream_root)
    assert sink.read_table(spark, stream_root, "rt_transactions").count() == 0

    names = register_raw(loaded) + register_staging(loaded) + register_published(published)
    names += register_stream(spark, stream_root, datetime(2024, 1, 5, 8))
    counted = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in names)
    counts = {r.table_name: r["rows"] for r in spark.sql(counted).collect()}
    assert counts["raw_transactions"] == counts["stg_transactions"] == 5
    assert (counts["fact_transactions"], counts["dq_transactions_duplicate"]) == (3, 2)
    assert set(CORE) | set(MARTS) <= set(names)
    assert spark.sql("SELECT * FROM mart_rt_events_per_minute ORDER BY event_minute DESC LIMIT 10").count() == 0
    got = rows(published.table("fact_transactions"), "transaction_id", "created_at", "amount_tgrk", "is_test_user")
    one = datetime(2024, 1, 1, 1)
    assert got == [(1, one, 2.5, 0), (3, one, 2.5, 0), (4, one, 10.0, 1)]
    net = published.table("mart_revenue_daily").agg(F.sum("net_revenue_tgrk")).first()[0]
    assert net == pytest.approx(15.0 - 2.5)

    second = rebuild(warehouse_of(loaded, datetime(2024, 2, 2)), published)
    assert second != first
    assert published.current() == second


def test_a_failed_check_publishes_nothing(spark, loaded, write_lines, tmp_path):
    published = Published(spark, f"{tmp_path}/out")
    stream_root = f"{tmp_path}/stream"
    first = rebuild(warehouse_of(loaded, datetime(2024, 2, 1)), published)
    send(spark, stream_root, 0, 9)
    # The same cancellation id twice on a day breaks the unique key of the fact.
    line = {"cancellation_id": 1, "original_transaction_id": 4, "reason": "x", "cancelled_at": "2024 Jan 02 05:00", "refund_amount": -1}
    write_lines(f"{tmp_path}/in/cancellations/day=2024-01-02/more_cancellations.jsonl", [line])
    loaded.load(f"{tmp_path}/in", CANCELLATIONS)
    with pytest.raises(CheckFailure, match="fact_cancellations.cancellation_nk unique: 1"):
        rebuild(warehouse_of(loaded, datetime(2024, 2, 2)), published, stream_root)
    assert published.current() == first
    assert sink.read_table(spark, stream_root, "rt_transactions").count() == 1


def test_batches_during_a_rebuild_are_kept(spark, loaded, tmp_path, monkeypatch):
    stream_root = f"{tmp_path}/stream"
    send(spark, stream_root, 0, 8)
    published = Published(spark, f"{tmp_path}/out")
    publish = Published.publish

    def late(self, *args):
        send(spark, stream_root, 1, 9)
        publish(self, *args)

    monkeypatch.setattr(Published, "publish", late)
    rebuild(warehouse_of(loaded, datetime(2024, 2, 1)), published, stream_root)
    assert [r.transaction_id for r in sink.read_table(spark, stream_root, "rt_transactions").collect()] == [9]


def test_feed_declarations():
    assert {f.table for f in FEEDS} == {
        "raw_transactions",
        "raw_cancellations",
        "raw_exchange_rates",
        "raw_users",
        "raw_test_users",
        "raw_promo_codes",
    }
    assert (TRANSACTIONS.files_per_task, CANCELLATIONS.files_per_task, EXCHANGE_RATES.files_per_task) == (200, 50, 50)
    assert TEST_USERS.defaults == {"test_user_uuid": ""} and "promo_code_id" in PROMO_CODES.defaults


def test_uncommitted_loads_are_left_out_without_a_shuffle(store, load, write_lines, tmp_path):
    write_lines(slot(tmp_path, "01-00"), [tx(1)])
    load(TRANSACTIONS)
    store.table(TRANSACTIONS).write.parquet(f"{store.root}/raw/raw_transactions/load_id=crashed")
    table = store.table(TRANSACTIONS)
    assert table.count() == 1
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_lines_that_are_not_one_object_are_rejected(store, load, write_lines, tmp_path, rows):
    bad = ['{"user_id":3}{"user_id":4}', '{"user_id":3} trailing', "{'user_id':2}", '{"user_id":3},{"user_id":4}', '{"user_id":3}]']
    write_lines(slot(tmp_path, "01-00"), [tx(1), *bad, ' {"transaction_id": 2} '])
    load(TRANSACTIONS)
    assert rows(store.table(TRANSACTIONS), "transaction_id") == [(1,), (2,)]
    assert rows(store.rejects(), "line") == sorted((b,) for b in bad)


def test_one_bad_file_costs_one_file(store, load, write_lines, tmp_path, rows, monkeypatch):
    for i in range(6):
        write_lines(slot(tmp_path, f"0{i}-00"), [tx(i)])
    write = RawStore._write_rows

    def failing(self, root, feed, names, load_id):
        if any("slot=03-00" in n for n in names):
            raise OSError("unreadable " + "x" * 2000)
        return write(self, root, feed, names, load_id)

    monkeypatch.setattr(RawStore, "_write_rows", failing)
    with pytest.raises(OSError, match="unreadable"):
        load(TRANSACTIONS)
    assert rows(store.table(TRANSACTIONS), "transaction_id") == [(i,) for i in (0, 1, 2, 4, 5)]
    failed = store.load_log().where("status = 'failed'").collect()
    assert [(r.source_file.split("slot=")[1][:5], len(r.error_message)) for r in failed] == [("03-00", 2011)]


def test_views_registered_first_show_later_batches(spark, tmp_path):
    root, at = f"{tmp_path}/stream", datetime(2024, 1, 5, 7, 30)
    register_stream(spark, root, at)
    count = lambda name: spark.sql(f"SELECT count(*) AS n FROM {name}").first().n
    assert count("rt_transactions") == count("mart_rt_events_per_minute") == 0
    send(spark, root, 0, 1)
    assert count("rt_transactions") == count("mart_rt_events_per_minute") == 1
    send(spark, root, 1, 2)
    assert count("rt_transactions") == 2 and spark.sql("SELECT transaction_count FROM mart_rt_data_quality_last_60m").first()[0] == 2
    sink.clear_tables(spark, root, through=sink.high_water(spark, root))
    assert count("rt_transactions") == count("mart_rt_current_hour_metrics") == 0
    send(spark, root, 2, 3)
    sink.clear_tables(spark, root, through=-1)
    assert count("rt_transactions") == 1


def test_a_later_publication_is_current_whatever_its_time(spark, loaded, tmp_path):
    published = Published(spark, f"{tmp_path}/out")
    for at in (datetime(2024, 2, 2), datetime(2024, 2, 1)):
        published.publish(at.isoformat(), at)
    assert published.current() == "2024-02-01T00:00:00"


def test_rates_without_a_readable_time_stop_the_rebuild(spark, loaded, write_lines, tmp_path):
    write_lines(f"{tmp_path}/in/exchange_rates/late/rates.jsonl", [{"update_id": 9, "timestamp": "soon", "rate_tgrk_punk": 2, "rate_tgrk_rub": 4}])
    loaded.load(f"{tmp_path}/in", EXCHANGE_RATES)
    with pytest.raises(CheckFailure, match="dim_exchange_rates.valid_from not_null: 2"):
        rebuild(warehouse_of(loaded, datetime(2024, 2, 1)), Published(spark, f"{tmp_path}/out"))


def test_rates_that_share_a_time_do_not_stop_the_rebuild(spark, loaded, write_lines, tmp_path, rows):
    same = [{"update_id": i, "timestamp": "1704067200", "rate_tgrk_punk": i, "rate_tgrk_rub": 2 * i} for i in (70, 72, 71, 72)]
    write_lines(f"{tmp_path}/in/exchange_rates/more/rates.jsonl", same)
    loaded.load(f"{tmp_path}/in", EXCHANGE_RATES)
    published = Published(spark, f"{tmp_path}/out")
    rebuild(warehouse_of(loaded, datetime(2024, 2, 1)), published)
    at = published.table("dim_exchange_rates").where("valid_from = TIMESTAMP'2024-01-01' AND update_id >= 70")
    held = rows(at.where("valid_from < valid_to"), "currency", "update_id", "rate")
    assert held == [("PUNK", 72, 72.0), ("RUB", 72, 144.0)] and at.count() == 8
    # a key of two rates that hold still does
    twice = published.table("dim_exchange_rates").where("valid_from < valid_to")
    with pytest.raises(CheckFailure, match="dim_exchange_rates.rate_key unique"):
        require(run_checks({"dim_exchange_rates": twice.union(twice)}, only=STOPPING))
