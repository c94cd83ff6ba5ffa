"""Semantics of the batch tables on literal rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from ledgerline.plans import audit, dims, facts, marts, staging
from ledgerline.plans.warehouse import Warehouse

TX = (
    "transaction_id bigint, user_id bigint, user_uuid string, amount double, currency string, transaction_type string, "
    "promo_code_id bigint, status string, created_at bigint, source_file string, loaded_at timestamp"
)
CANCEL = (
    "cancellation_id bigint, original_transaction_id bigint, reason string, cancelled_at string, refund_amount double, "
    "source_file string, loaded_at timestamp"
)
RATE = (
    "update_id bigint, timestamp string, rate_tgrk_punk double, rate_tgrk_rub double, source_file string, "
    "loaded_at timestamp"
)
USER = "user_id bigint, user_uuid string, is_test_user boolean, source_file string, loaded_at timestamp"
TEST_USER = "test_user_uuid string, source_file string, loaded_at timestamp"
PROMO = "promo_code_id bigint, code string, max_uses bigint, expiry_date string, source_file string, loaded_at timestamp"
NOW = datetime(2024, 2, 1)
DAY = 1704067200  # 2024-01-01 00:00:00 UTC


def tx(id, at=DAY + 3600, amount=10.0, currency="TGRK", kind="purchase", status="completed", user="u1", promo=None, slot="01-00"):
    path = f"transactions/day=2024-01-01/slot={slot}/transactions.jsonl"
    return (id, 1, user, amount, currency, kind, promo, status, at, path, NOW)


def cancel(id, target, at="2024 Jan 02 05:00", refund=-10.0, reason="other"):
    return (id, target, reason, at, refund, "cancellations/day=2024-01-02/cancellations.jsonl", NOW)


@pytest.fixture
def build(spark):
    def make(txs=(), cancels=(), rates=(), users=((1, "u1", False, "f", NOW),), tests=(), promos=()):
        return Warehouse(
            transactions=spark.createDataFrame(list(txs), TX),
            cancellations=spark.createDataFrame(list(cancels), CANCEL),
            exchange_rates=spark.createDataFrame(list(rates), RATE),
            users=spark.createDataFrame(list(users), USER),
            test_users=spark.createDataFrame(list(tests), TEST_USER),
            promo_codes=spark.createDataFrame(list(promos), PROMO),
            run_ts=NOW,
        )

    return make


def test_every_row_of_a_collision_leaves_the_fact(build, rows):
    w = build([tx(1, amount=1.0), tx(1, at=DAY, amount=2.0), tx(1, slot="01-30"), tx(2)])
    got = rows(w.stg_transactions, "transaction_nk", "amount", "transaction_dup_rn", "transaction_dup_cnt", "is_transaction_duplicate")
    assert got == [
        ("202401010100#1", 1.0, 2, 2, 1),
        ("202401010100#1", 2.0, 1, 2, 1),
        ("202401010100#2", 10.0, 1, 1, 0),
        ("202401010130#1", 10.0, 1, 1, 0),
    ]
    assert rows(w.fact_transactions, "transaction_nk") == [("202401010100#2",), ("202401010130#1",)]
    assert rows(w.dq_transactions_duplicate, "amount") == [(1.0,), (2.0,)]


def test_a_file_loaded_twice_collides_as_a_whole(build):
    w = build([tx(1), tx(2)] * 2)
    assert w.fact_transactions.count() == 0 and w.dq_transactions_duplicate.count() == 4


def test_flags_are_independent(build, rows):
    w = build([tx(1, amount=-1.0, status="failed", user=""), tx(2, amount=0.0, kind="view", user="  "), tx(3, user=None)])
    columns = ["transaction_id", "is_empty_user", "is_negative_amount", "is_zero_amount", "is_completed", "is_purchase"]
    assert rows(w.stg_transactions, *columns) == [(1, 1, 1, 0, 0, 1), (2, 0, 0, 1, 1, 0), (3, 1, 0, 0, 1, 1)]


def test_user_precedence(build, rows):
    users = [(1, "u1", False, "users", NOW), (2, "u2", True, "users", NOW), (3, "", False, "users", NOW)]
    tests = [("u1", "tests", NOW), ("t9", "tests", NOW), ("t9", "tests2", NOW)]
    w = build(users=users, tests=tests)
    assert rows(w.stg_users, "user_uuid", "user_id", "is_test_user", "source_file") == [
        (None, -1, True, None),
        ("t9", -1, True, "tests"),
        ("u1", 1, False, "users"),
        ("u2", 2, True, "users"),
    ]
    assert rows(w.dim_users, "user_uuid", "user_id", "is_test_user", "source_file") == [
        ("t9", -1, 1, "tests2"),
        ("u1", 1, 0, "users"),
        ("u2", 2, 1, "users"),
    ]


def test_user_flags_in_the_fact(build, rows):
    w = build([tx(1), tx(2, user="t9"), tx(3, user="nobody"), tx(4, user="")], tests=[("t9", "tests", NOW)])
    assert rows(w.fact_transactions, "transaction_id", "is_test_user", "is_unknown_user") == [
        (1, 0, 0),
        (2, 1, 0),
        (3, 0, 1),
        (4, 0, 0),
    ]


def test_rate_intervals_and_ties(build, rows):
    rates = [(5, str(DAY), 2.0, 20.0, "r", NOW), (7, str(DAY), 4.0, 40.0, "r", NOW), (6, str(DAY + 60), 0.0, 60.0, "r", NOW)]
    w = build(rates=rates + rates[-1:])
    start, minute, end = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1), datetime(2100, 1, 1)
    punk = [r[1:] for r in rows(w.dim_exchange_rates, "currency", "update_id", "valid_from", "valid_to", "rate", "is_current") if r[0] == "PUNK"]
    assert punk == [
        (5, start, start, 2.0, 0),
        (6, minute, minute, 0.0, 0),
        (6, minute, end, 0.0, 1),
        (7, start, minute, 4.0, 0),
    ]
    base = [r for r in rows(w.dim_exchange_rates, "currency", "valid_from", "valid_to", "rate") if r[0] == "TGRK"]
    assert base == [("TGRK", datetime(1970, 1, 1), end, 1.0)]


def test_the_fact_reads_one_rate_per_currency_and_time(build, rows):
    rates = [(5, str(DAY), 2.0, 20.0, "r", NOW), (7, str(DAY), 4.0, 40.0, "r", NOW), (7, str(DAY), 4.0, 40.0, "r", NOW), (8, "soon", 1.0, 1.0, "r", NOW)]
    w = build([tx(1, at=DAY, currency="RUB")], rates=rates)
    start, end = datetime(2024, 1, 1), datetime(2100, 1, 1)
    assert [r for r in rows(w.held_rates, "currency", "update_id", "valid_from", "valid_to", "rate") if r[0] == "PUNK"] == [("PUNK", 7, start, end, 4.0)]
    read = w.fact_transactions.inputFiles()
    assert any("/held-rates-" in f for f in read) and not any("/dim_exchange_rates-" in f for f in read)
    keyed = {r.rate_key for r in w.dim_exchange_rates.where("valid_from < valid_to AND currency = 'RUB'").collect()}
    assert rows(w.fact_transactions, "exchange_rate", "rate_key") == [(40.0, *keyed)]
    assert w.dim_exchange_rates.where("currency = 'RUB'").count() == 4


def test_checks_read_the_stored_fact(spark, monkeypatch):
    from ledgerline.trial import catalog

    seen = {}
    monkeypatch.setattr(catalog, "run_checks", lambda tables: seen.update(tables))
    catalog._column_checks(spark, "/root/testdata/sf0.001")
    for name in ["fact_transactions", "fact_cancellation_matches"]:
        assert all(f"/{name}-" in f for f in seen[name].inputFiles())


def test_candidates_are_counted_and_picked_in_one_pass(spark):
    day, at = date(2024, 1, 1), datetime(2024, 1, 1, 5)
    given = [(1, "5.0", day, "a", at, None, "RUB", 0), (2, "7.0", day, "c", at, 1.0, "RUB", 0), (2, "7.0", day, "b", at, 2.0, "PUNK", 1)]
    names = "_id bigint, _amount string, _day date, transaction_nk string, created_at timestamp, amount_tgrk double, currency string, is_test_user int"
    found = facts._candidates(spark.createDataFrame(given, names))
    assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    got = {r._id: (r._n, r._pick and tuple(r._pick)) for r in found.collect()}
    assert got == {1: (1, ("a", at, None, "RUB", 0)), 2: (2, None)}


def test_conversion_divides_by_the_latest_rate(build, rows):
    rates = [(5, str(DAY), 2.0, 20.0, "r", NOW), (6, str(DAY + 60), 0.0, 40.0, "r", NOW)]
    txs = [
        tx(1, at=DAY - 1, currency="RUB"),
        tx(2, at=DAY, currency="RUB"),
        tx(3, at=DAY + 59, currency="RUB"),
        tx(4, at=DAY + 60, currency="RUB"),
        tx(5, at=DAY + 60, currency="PUNK"),
        tx(6, currency="TGRK"),
        tx(7, currency="ZZZ"),
    ]
    got = rows(build(txs, rates=rates).fact_transactions, "transaction_id", "exchange_rate", "is_rate_missing", "amount_tgrk")
    assert got == [
        (1, None, 1, None),
        (2, 20.0, 0, 0.5),
        (3, 20.0, 0, 0.5),
        (4, 40.0, 0, 0.25),
        (5, 0.0, 1, None),
        (6, 1.0, 0, 10.0),
        (7, None, 1, None),
    ]


def test_promo_flags(build, rows):
    promos = [(1, "A", 1, "2023-12-31", "p", NOW), (2, "B", 0, "never", "p", NOW), (3, "C", 5, "2024-01-01", "p", NOW)]
    w = build([tx(1, promo=1), tx(2, promo=2), tx(3, promo=3), tx(4, promo=9), tx(5)], promos=promos)
    columns = ["transaction_id", "promo_code", "is_promo_used", "is_unknown_promo", "is_promo_expired"]
    assert rows(w.fact_transactions, *columns) == [
        (1, "A", 1, 0, 1),
        (2, "B", 1, 0, 0),
        (3, "C", 1, 0, 0),
        (4, None, 1, 1, 0),
        (5, None, 0, 0, 0),
    ]


def test_cancellation_matching(build, rows):
    txs = [
        tx(1),
        tx(2),
        tx(2, slot="01-30"),
        tx(3, kind="view", status="failed", amount=-10.0),
        tx(0),
        tx(5, at=DAY + 10 * 3600 + 3540),
    ]
    cancels = [
        cancel(1, 1),
        cancel(2, 2),
        cancel(3, 3),
        cancel(4, 0),
        cancel(5, 5, at="2024 Jan 02 12:01"),
        cancel(6, 1, at="2024 Jan 03 05:00"),
        cancel(7, 1, refund=-9.0),
        cancel(8, 1, at="bad"),
        cancel(9, 1),
        cancel(9, 1),
    ]
    w = build(txs, cancels)
    got = rows(w.fact_cancellation_matches, "cancellation_id", "candidate_count", "match_status", "matched_transaction_nk", "hours_to_cancel")
    assert got == [
        (1, 1, "matched", "202401010100#1", 28),
        (2, 2, "ambiguous", None, None),
        (3, 1, "matched", "202401010100#3", 28),
        (4, 0, "unmatched", None, None),
        (5, 1, "matched", "202401010100#5", 26),
        (6, 0, "unmatched", None, None),
        (7, 0, "unmatched", None, None),
        (8, 0, "unmatched", None, None),
        (9, 2, "ambiguous", None, None),
    ]


def test_matching_a_hot_key_does_not_pair_rows(spark, rows):
    """300 transactions and 300 cancellations on one key: counts multiply, rows do not."""
    fact = spark.range(300).selectExpr(
        "cast(7 as bigint) transaction_id", "concat('n', id) transaction_nk", "5.0D amount", "5.0D amount_tgrk",
        "'TGRK' currency", "0 is_test_user", "timestamp'2024-01-01 10:00:00' created_at",
    )
    cancelled = spark.range(300).selectExpr(
        "concat('c', id) cancellation_nk", "id cancellation_id", "cast(7 as bigint) original_transaction_id", "'x' reason",
        "timestamp'2024-01-02 10:00:00' cancelled_at", "-5.0D refund_amount",
    )
    got = facts.cancellation_matches(cancelled, fact)
    assert got.count() == 300
    assert rows(got.select("candidate_count", "match_status").distinct()) == [(300, "ambiguous")]


def test_matching_without_the_broadcast_filter(build, rows, monkeypatch):
    txs, cancels = [tx(1), tx(2), tx(3)], [cancel(1, 1), cancel(2, 9)]
    expected = rows(build(txs, cancels).fact_cancellation_matches.drop("loaded_at"))
    monkeypatch.setattr(facts, "fits_broadcast", lambda settled: False)
    assert rows(build(txs, cancels).fact_cancellation_matches.drop("loaded_at")) == expected


def test_a_stray_cancellation_reads_one_more_day(spark, rows, tmp_path):
    """The fact is pruned to the asked days themselves while the query runs."""
    day = "date_add(date'2024-01-01', cast(id % 20 as int))"
    made = spark.range(200).selectExpr(
        "id + 1 transaction_id", "concat('n', id) transaction_nk", "5.0D amount", "5.0D amount_tgrk", "'TGRK' currency",
        "0 is_test_user", f"cast({day} as timestamp) created_at",
    )
    facts.by_day(made).write.partitionBy("created_day").parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    cancelled = spark.createDataFrame(
        [("c1", 1, 3, "x", datetime(2024, 1, 4), -5.0), ("c2", 2, 9, "x", datetime(1970, 1, 2), -5.0)],
        "cancellation_nk string, cancellation_id bigint, original_transaction_id bigint, reason string, cancelled_at timestamp, refund_amount double",
    )
    keys = spark.createDataFrame([(date(2024, 1, 3),), (date(1970, 1, 1),)], "_day date")
    pruned = facts._on_days(fact, keys)
    assert pruned.count() == 10
    pruned.collect()
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert rows(facts.cancellation_matches(cancelled, fact), "cancellation_id", "match_status") == [(1, "matched"), (2, "unmatched")]


def test_unused_promo_has_no_uses(build, rows):
    promos = [(1, "A", 1, "2024-01-01", "p", NOW), (2, "B", 0, "2024-01-01", "p", NOW)]
    txs = [tx(1, promo=1), tx(2, promo=1), tx(3, promo=1, status="failed", at=DAY + 90000)]
    columns = ["promo_code_id", "is_test_user", "real_uses", "uses_total", "uses_completed_purchase", "uses_expired", "usage_pct", "is_limit_exceeded", "revenue_tgrk"]
    assert rows(build(txs, promos=promos).mart_promo_usage, *columns) == [
        (1, 0, 2, 3, 2, 1, 1.0, 1, 20.0),
        (2, None, 0, 0, 0, 0, None, 0, None),
    ]


def test_sums_without_a_hit(build, rows):
    w = build([tx(1, kind="view", currency="ZZZ")])
    columns = ["total_amount_original", "total_amount_tgrk", "purchase_amount_original", "purchase_amount_tgrk", "avg_exchange_rate"]
    assert rows(w.mart_currency_daily, *columns) == [(10.0, None, 0.0, None, None)]


def test_days_with_cancellations_only(build, rows):
    """The revenue mart keeps them, the traffic mart does not; unmatched refunds count as real users'."""
    w = build([tx(1)], [cancel(1, 1), cancel(2, 8, refund=-3.0)])
    assert rows(w.mart_revenue_daily, "revenue_date", "gross_revenue_tgrk", "matched_refunds_tgrk", "net_revenue_tgrk", "unmatched_refund_amount_original") == [
        (date(2024, 1, 1), 10.0, 0.0, 10.0, 0.0),
        (date(2024, 1, 2), 0.0, 10.0, -10.0, 3.0),
    ]
    assert rows(w.mart_traffic_source_daily, "event_date", "is_test_user") == [(date(2024, 1, 1), 0)]


def test_cohort_day_ignores_the_test_flag(spark, rows):
    schema = "user_uuid string, is_test_user int, created_at timestamp, is_purchase int, is_completed int, amount_tgrk double"
    data = [
        ("a", 0, datetime(2024, 1, 1, 9), 1, 1, 1.0),
        ("a", 1, datetime(2024, 1, 2, 9), 1, 1, 2.0),
        ("a", 1, datetime(2024, 1, 2, 10), 1, 1, None),
        ("b", 1, datetime(2024, 1, 2, 9), 1, 1, 4.0),
        ("b", 1, datetime(2024, 1, 1, 9), 1, 0, 4.0),
        (None, 0, datetime(2024, 1, 1, 9), 1, 1, 4.0),
    ]
    got = rows(marts.user_cohorts(spark.createDataFrame(data, schema)))
    first, second = date(2024, 1, 1), date(2024, 1, 2)
    assert got == [(first, first, 0, 0, 1, 1, 1.0), (first, second, 1, 1, 1, 2, 2.0), (second, second, 0, 1, 1, 1, 4.0)]


def test_invariants(build, rows):
    txs = [tx(i, amount=float(i), currency=["TGRK", "RUB", "ZZZ"][i % 3]) for i in range(1, 30)] + [tx(3), tx(4)]
    cancels = [cancel(i, i, refund=-float(i)) for i in range(1, 12)]
    w = build(txs, cancels, rates=[(1, str(DAY), 2.0, 5.0, "r", NOW)])
    quality = w.mart_data_quality_daily.groupBy().sum().first().asDict()
    assert quality["sum(raw_transaction_rows)"] == len(txs)
    assert quality["sum(clean_transaction_rows)"] + quality["sum(quarantined_duplicate_rows)"] == len(txs)
    assert quality["sum(duplicate_transaction_groups)"] == quality["sum(quarantined_duplicate_groups)"] == 2
    statuses = ["matched", "ambiguous", "unmatched"]
    assert sum(quality[f"sum({s}_cancellation_rows)"] for s in statuses) == len(cancels)
    for r in w.mart_revenue_daily.collect():
        assert r.net_revenue_tgrk == pytest.approx(r.gross_revenue_tgrk - r.matched_refunds_tgrk)


def test_promo_dim_takes_one_whole_row(spark, rows):
    staged = spark.createDataFrame([(1, "B", 1, None), (1, "A", 9, None)], "promo_code_id bigint, code string, max_uses bigint, expiry_date date")
    assert rows(dims.promo_codes(staged), "promo_code_id", "code", "max_uses") == [(1, "A", 9)]


def test_cancellation_key_and_dates(spark, rows):
    raw = spark.createDataFrame([cancel(4, 1), cancel(5, 1, at="?")], CANCEL)
    assert rows(staging.cancellations(raw), "cancellation_nk", "cancelled_at") == [
        ("20240102#4", datetime(2024, 1, 2, 5)),
        ("20240102#5", None),
    ]


def test_quarantine_reads_in_key_order(build):
    w = build([tx(2), tx(2, at=DAY), tx(1), tx(1, slot="01-30"), tx(1, slot="01-30")])
    got = [r.transaction_nk for r in audit.ordered_quarantine(w.dq_transactions_duplicate).collect()]
    assert got == ["202401010100#2"] * 2 + ["202401010130#1"] * 2
