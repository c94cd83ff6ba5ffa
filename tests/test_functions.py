from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import fields, flags, keys, times


def one(spark, value, column):
    schema = "v string" if value is None or isinstance(value, str) else None
    frame = spark.createDataFrame([(value,)], schema or ["v"])
    return frame.select(column(F.col("v")).alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024 Jan 05 07:08", datetime(2024, 1, 5, 7, 8)),
        ("2024-01-05 07:08:09", datetime(2024, 1, 5, 7, 8, 9)),
        ("2024-01-05T07:08:09Z", datetime(2024, 1, 5, 7, 8, 9)),
        ("2024-01-05T07:08:09.250+03:00", datetime(2024, 1, 5, 4, 8, 9, 250000)),
        ("05/01/2024", datetime(2024, 1, 5)),
        ("1704438489", datetime(2024, 1, 5, 7, 8, 9)),
        ("bad date", None),
        ("", None),
        (None, None),
    ],
)
def test_lenient_time(spark, text, expected):
    assert one(spark, text, times.lenient_time) == expected


@pytest.mark.parametrize(
    "text, expected", [("2024-01-05", date(2024, 1, 5)), ("never", None), ("2024-13-01", None), (None, None)]
)
def test_lenient_date(spark, text, expected):
    assert one(spark, text, times.lenient_date) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("1704438489", datetime(2024, 1, 5, 7, 8, 9)), ("2024-01-05 07:08:09", datetime(2024, 1, 5, 7, 8, 9)), ("x", None)],
)
def test_rate_time(spark, text, expected):
    assert one(spark, text, times.rate_time) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-05T07:08:09Z", datetime(2024, 1, 5, 7, 8, 9)),
        ("2024-01-05T07:08:09.123456+03:00", datetime(2024, 1, 5, 4, 8, 9, 123000)),
        ("2024-01-05T07:08:09", None),
        ("2024-01-05 07:08:09", None),
        ("yesterday", None),
        (None, None),
    ],
)
def test_published_time_needs_an_offset(spark, text, expected):
    assert one(spark, text, times.published_time) == expected


def test_hours_crossed_counts_boundaries(spark):
    frame = spark.createDataFrame(
        [
            (datetime(2024, 1, 1, 10, 59), datetime(2024, 1, 1, 12, 1)),
            (datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 59)),
            (datetime(2024, 1, 2, 0, 1), datetime(2024, 1, 1, 23, 59)),
        ],
        ["a", "b"],
    )
    got = [r.h for r in frame.select(times.hours_crossed(F.col("a"), F.col("b")).alias("h")).collect()]
    assert got == [2, 0, -1]


def test_event_time_falls_back_to_the_slot(spark):
    path = "transactions/day=2024-01-05/slot=07-30/transactions.jsonl"
    frame = spark.createDataFrame([(1704438489, path), (0, path), (None, path), (0, "x.jsonl")], ["e", "p"])
    got = [r.t for r in frame.select(times.event_time(F.col("e"), F.col("p")).alias("t")).collect()]
    slot = datetime(2024, 1, 5, 7, 30)
    assert got == [datetime(2024, 1, 5, 7, 8, 9), slot, slot, None]


def test_natural_keys(spark):
    frame = spark.createDataFrame([("a/day=2024-01-05/slot=07-30/t.jsonl", 7), ("t.jsonl", 7)], ["p", "i"])
    got = frame.select(
        keys.transaction_key(F.col("p"), F.col("i")).alias("t"), keys.cancellation_key(F.col("p"), F.col("i")).alias("c")
    ).collect()
    assert [tuple(r) for r in got] == [("202401050730#7", "20240105#7"), ("#7", "#7")]


def test_content_id_keeps_null_parts_in_place(spark):
    frame = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    got = [r.k for r in frame.select(keys.content_id(F.col("x"), F.col("y"), F.col("z")).alias("k")).collect()]
    # MD5 of 'a||b' and of 'a|b|'.
    import hashlib

    assert got == [hashlib.md5(t.encode()).hexdigest() for t in ("a||b", "a|b|")]


@pytest.mark.parametrize("text, expected", [("7", 7), ("7.9", 7), ("-7.9", -7), (" ", None), ("x", None), (None, None)])
def test_whole_number(spark, text, expected):
    assert one(spark, text, fields.whole_number) == expected


@pytest.mark.parametrize("text, expected", [("", False), (None, False), ("n/a", True), ("1.5", False), ("1e3", False)])
def test_unreadable(spark, text, expected):
    assert bool(one(spark, text, fields.unreadable)) is expected


def test_convert_is_null_for_no_rate(spark):
    frame = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, None)], "a double, r double")
    assert [r.c for r in frame.select(flags.convert(F.col("a"), F.col("r")).alias("c")).collect()] == [2.5, None, None]


def test_blank_rules_differ(spark):
    frame = spark.createDataFrame([("",), ("  ",), ("u",), (None,)], "v string")
    got = frame.select(flags.blank_to_null(F.col("v")).alias("b"), fields.text_or_null(F.col("v")).alias("s")).collect()
    assert [tuple(r) for r in got] == [(None, None), ("  ", None), ("u", "u"), (None, None)]


def test_a_time_without_zone_is_utc():
    from datetime import timedelta, timezone

    naive, east = datetime(2024, 1, 5, 7), datetime(2024, 1, 5, 10, tzinfo=timezone(timedelta(hours=3)))
    assert times.utc(naive) == times.utc(east) and times.utc(naive).tzinfo is timezone.utc


@pytest.mark.parametrize(
    "text,expected",
    [("1e25", 1e25), ("123456789012345678901.5", 123456789012345678901.5), (" -3.5 ", -3.5), ("NaN", None), ("Infinity", None), ("0x10", None), ("1d", None)],
)
def test_numbers_of_any_size(spark, text, expected):
    from ledgerline.functions import fields

    assert one(spark, text, fields.number) == expected


@pytest.mark.parametrize(
    "text,expected", [("2024-01-05", "2024-01-05"), ("2024", None), ("2024-3", None), ("2024-01-05 xyz", None), ("2024-13-01", None)]
)
def test_only_full_dates_are_dates(spark, text, expected):
    got = one(spark, text, times.lenient_date)
    assert (str(got) if got else None) == expected
