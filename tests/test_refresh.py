"""Rebuilds of touched days against full rebuilds."""

from __future__ import annotations

from datetime import datetime

import pytest

from ledgerline.operators.collisions import colliding_keys
from ledgerline.plans import refresh
from ledgerline.plans.refresh import DayStore, NewRows
from ledgerline.plans.warehouse import Warehouse
from ledgerline.sources.daytables import DayTables
from ledgerline.sources.keyed import KeyedRows
from ledgerline.sources.loader import RawStore

from test_plans import CANCEL, DAY, NOW, PROMO, RATE, TEST_USER, TX, USER, cancel, tx

TABLES = [
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
SCHEMAS = {
    "transactions": TX,
    "cancellations": CANCEL,
    "exchange_rates": RATE,
    "users": USER,
    "test_users": TEST_USER,
    "promo_codes": PROMO,
}
HOURS = 3600


def day_tx(id, day, **more):
    """A transaction of January ``day``, in the file of that day."""
    row = list(tx(id, at=DAY + (day - 1) * 24 * HOURS + more.pop("hour", 1) * HOURS, **more))
    row[9] = row[9].replace("day=2024-01-01", f"day=2024-01-{day:02d}")
    return tuple(row)


def rate(id, day, hour=0, punk=2.0, rub=20.0):
    return (id, str(DAY + ((day - 1) * 24 + hour) * HOURS), punk, rub, "r", NOW)


def rounded(found):
    """Sums may be added up in another order."""
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in found]


FIRST = {
    "transactions": [day_tx(10 * d + i, d, user=f"u{i}", amount=float(i + d), promo=i % 3 or None, currency="RUB" if i % 2 else "TGRK") for d in range(1, 7) for i in range(4)],
    "cancellations": [cancel(d, 10 * d + 1, at=f"2024 Jan {d + 1:02d} 05:00", refund=-float(1 + d)) for d in range(1, 6)],
    "exchange_rates": [rate(1, 1), rate(2, 4)],
    "users": [(1, "u1", False, "f", NOW), (2, "u2", False, "f", NOW)],
    "test_users": [],
    "promo_codes": [(1, "A", 1, "2024-01-31", "p", NOW)],
}


@pytest.fixture
def frames(spark):
    def make(rows):
        return {name: spark.createDataFrame(list(rows[name]), SCHEMAS[name]) for name in rows}

    return make


class Followed:
    """A store that takes rows in step by step, and all rows it got."""

    def __init__(self, spark, frames, rows, root):
        self.frames, self.rows = frames, rows
        self.store = DayStore(spark, root, buckets=2)
        self.every = {name: [] for name in SCHEMAS}

    def take(self, **batch):
        """What each table had written."""
        for name, found in batch.items():
            self.every[name] += found
        return self.store.refresh(NewRows(**self.frames(batch)), NOW)

    def compare(self, tables=TABLES):
        warehouse = Warehouse(**self.frames(self.every), run_ts=NOW)
        for name in tables:
            full = getattr(warehouse, name)
            assert rounded(self.rows(self.store.read(name), *full.columns)) == rounded(self.rows(full)), name


@pytest.fixture
def followed(spark, frames, rows, tmp_path):
    return Followed(spark, frames, rows, str(tmp_path / "days"))


def test_late_transactions(followed):
    followed.take(**FIRST)
    assert not any(followed.take().values())

    # January 3: one row collides, one is cancelled on January 4
    written = followed.take(transactions=[day_tx(99, 3, user="u1"), day_tx(31, 3, user="u9", hour=9)])
    assert written["fact_transactions"] | written["mart_currency_daily"] == {"2024-01-03"}
    assert written["dq_transactions_duplicate"] == {"2024-01-03"}
    assert written["fact_cancellation_matches"] == {"20240102"}  # as the file day is in the keys
    assert written["mart_revenue_daily"] >= {"2024-01-03", "2024-01-04"}
    assert "dim_exchange_rates" not in written and "dim_users" not in written

    # a file of January 2 with rows of January 5, without a time, and of long ago
    odd = [list(day_tx(70 + i, 2)) for i in range(3)]
    odd[0][8], odd[1][8], odd[2][8] = DAY + 4 * 24 * HOURS, 0, 5
    written = followed.take(transactions=[tuple(r) for r in odd])
    assert written["fact_transactions"] == {"2024-01-05", "2024-01-02", "1970-01-01"}
    followed.compare()


def test_users_promos_and_cohorts(followed):
    more = [day_tx(900, 4, user="rare"), day_tx(901, 5, promo=77), *(day_tx(500 + d, d, user="mover") for d in (3, 5))]
    followed.take(**{**FIRST, "transactions": [*FIRST["transactions"], *more]})
    assert followed.take(test_users=[("rare", "t", NOW)])["fact_transactions"] == {"2024-01-04"}
    written = followed.take(promo_codes=[(77, "Z", 3, "2024-01-01", "p", NOW)])
    assert written["fact_transactions"] == {"2024-01-05"} and written["dim_promo_codes"] == {"all"}

    # an earlier first purchase arrives late, then it is lost to a collision
    moved = {"2024-01-01", "2024-01-03", "2024-01-05"}
    assert followed.take(transactions=[day_tx(550, 1, user="mover")])["mart_user_cohorts"] >= moved
    followed.compare(["mart_user_cohorts"])
    assert followed.take(transactions=[day_tx(550, 1, user="other")])["mart_user_cohorts"] >= moved
    followed.compare()


def test_rates_and_cancellations(followed, monkeypatch):
    """Rates between others, tied, before all and after all; cancellations by themselves, one key twice."""
    monkeypatch.setattr(refresh._Refresh, "check", lambda self: None)  # ties and repeated keys would stop a run
    followed.take(**FIRST)
    written = followed.take(exchange_rates=[rate(7, 2, 0, 3.0, 33.0)])
    assert written["fact_transactions"] == {"2024-01-02", "2024-01-03"}
    assert written["dim_exchange_rates"] == {"2024-01-01", "2024-01-02"}
    written = followed.take(exchange_rates=[rate(3, 2, 12, 3.0, 30.0), rate(4, 4, 0, 5.0, 50.0), rate(0, 4, 0, 7.0, 70.0)])
    assert written["fact_transactions"] == {f"2024-01-0{d}" for d in (2, 3, 4, 5, 6)}
    undated = (9, "soon", 1.0, 1.0, "r", NOW)
    written = followed.take(exchange_rates=[rate(5, 6, 2, 9.0, 90.0), undated])
    assert written["dim_exchange_rates"] == {"2024-01-04", "2024-01-06", "none"}
    assert written["fact_transactions"] == {"2024-01-06"}
    written = followed.take(exchange_rates=[rate(8, 0, 0, 1.5, 15.0)])
    assert written["dim_exchange_rates"] == {"2023-12-31"} and "fact_transactions" not in written
    followed.compare(["dim_exchange_rates", "fact_transactions"])

    late = [cancel(50, 21, at="2024 Jan 03 07:00", refund=-3.0), cancel(51, 7, at="?"), cancel(1, 11, refund=-2.0)]
    written = followed.take(cancellations=late)
    assert "fact_transactions" not in written and written["mart_revenue_daily"] >= {"2024-01-03"}
    followed.compare()


def test_each_load_is_taken_in_once(spark, tmp_path, write_lines):
    """Loads of two days, one run after each: the second takes the second load only."""
    root, days = str(tmp_path / "in"), DayStore(spark, str(tmp_path / "days"), buckets=2)
    store = RawStore(spark, str(tmp_path / "store"))

    def load(day, ids):
        lines = [{"transaction_id": i, "user_id": 1, "user_uuid": "u1", "amount": 5.0, "currency": "TGRK", "transaction_type": "purchase", "status": "completed", "created_at": DAY + (day - 1) * 24 * HOURS} for i in ids]
        write_lines(f"{root}/transactions/day=2024-01-{day:02d}/slot=00-00/transactions.jsonl", lines)
        store.load_all(root)
        return days.refresh_store(store, run_ts=NOW)

    store.load_all(root)
    days.refresh_store(store, run_ts=NOW)  # nothing is there yet
    assert all(days.read(name).count() == 0 for name in TABLES if name != "dim_exchange_rates")
    load(1, [1, 2, 3])
    written = load(2, [1, 2])
    assert written["fact_transactions"] == {"2024-01-02"} and "dim_users" not in written
    assert written["mart_revenue_daily"] == {"2024-01-02"}
    assert days.read("fact_transactions").count() == 5
    assert not any(n for n in days.refresh_store(store, run_ts=NOW) if n.startswith("fact"))


def test_a_failed_run_is_not_seen(spark, frames, tmp_path, monkeypatch):
    store = DayStore(spark, str(tmp_path / "days"), buckets=2)
    store.refresh(NewRows(**frames(FIRST)), NOW)
    before = store.read("fact_transactions").count()
    late = {"transactions": [day_tx(99, 3), day_tx(98, 3)]}
    monkeypatch.setattr(refresh._Refresh, "check", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.refresh(NewRows(**frames(late)), NOW)
    assert store.read("fact_transactions").count() == before
    monkeypatch.undo()
    store.refresh(NewRows(**frames(late)), NOW)
    assert store.read("fact_transactions").count() == before + 2


def test_raw_rows_are_scanned_once_and_keys_counted_without_a_shuffle(spark, frames, tmp_path):
    keyed = KeyedRows(spark, str(tmp_path), buckets=2)
    source = str(tmp_path / "raw")
    frames(FIRST)["transactions"].write.parquet(source)
    raw = spark.read.parquet(source)
    days = keyed.insert(raw, "r1")
    rows = keyed.rows(dict.fromkeys(days, ("r1",)), ["2024-01-02", "2024-01-03"])
    plan = colliding_keys(rows, "transaction_nk")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan and "2024-01-02" in plan
    assert rows.count() == 8
    assert KeyedRows.keyed(raw, "r")._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert keyed.insert(raw, "r1") == days and keyed.rows(dict.fromkeys(days, ("r1",)), days).count() == 24


def test_tables_read_the_keyed_rows_and_not_the_raw_ones(spark, frames, rows, tmp_path):
    """After the one scan that stores them, no plan of a table has the raw folder in it."""
    source = str(tmp_path / "raw-transactions")
    frames(FIRST)["transactions"].write.parquet(source)
    given = {**frames(FIRST), "transactions": spark.read.parquet(source)}
    plain, stored = Warehouse(**given, run_ts=NOW), Warehouse(**given, run_ts=NOW)
    stored.store_keyed()
    for name in ("stg_transactions", "fact_transactions", "dq_transactions_duplicate", "mart_data_quality_daily"):
        built = getattr(stored, name)
        assert "raw-transactions" not in built._jdf.queryExecution().toString(), name
        assert rounded(rows(built, *built.columns)) == rounded(rows(getattr(plain, name), *built.columns)), name


def test_a_new_session_finds_the_stored_rows(spark, frames, tmp_path):
    keyed = KeyedRows(spark, str(tmp_path), buckets=2)
    raw = frames(FIRST)["transactions"]
    days = keyed.insert(raw, "r1")
    spark.sql(f"DROP TABLE {keyed.table}")
    again = KeyedRows(spark, str(tmp_path), buckets=2)
    assert again.rows(dict.fromkeys(days, ("r1",)), days).count() == 24


def test_readers_of_an_old_snapshot_go_on(spark, tmp_path):
    tables = DayTables(spark, str(tmp_path))

    def put(value):
        run = tables.begin()
        run.replace("t", spark.createDataFrame([(value, "2024-01-01")], "v int, day string"), ["2024-01-01"])
        run.publish()

    put(1)
    old = tables.snapshot().read("t")
    put(2)
    assert [r.v for r in old.collect()] == [1] and [r.v for r in tables.snapshot().read("t").collect()] == [2]
    for value in (3, 4):
        put(value)
    assert [r.v for r in tables.snapshot().read("t").collect()] == [4]
    assert len(tables.folders(str(tmp_path / "tables/t"), "run=")) >= 3 and len(tables.manifests()) == 3


def test_rates_that_share_a_time(followed):
    """Late rates at times that are taken already: the greatest of each holds, the run is not stopped."""
    followed.take(**FIRST)
    followed.take(exchange_rates=[rate(9, 4, punk=3.0), rate(8, 4, punk=7.0), rate(9, 4, punk=3.0), rate(7, 2), rate(6, 2)])
    followed.compare()
