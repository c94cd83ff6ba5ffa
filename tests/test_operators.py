"""Operators against brute force, with hot groups."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import bitmaps
from ledgerline.operators import asof
from ledgerline.operators.asof import asof_left_join, choose_buckets, next_start
from ledgerline.operators.checks import Check, CheckFailure, require, run_checks
from ledgerline.operators.collisions import distinct_per, with_group_size
from ledgerline.operators.combine import combine
from ledgerline.operators.copies import restore_copies
from ledgerline.operators.latest import latest_per_key
from ledgerline.operators.lookup import left_lookup
from ledgerline.operators.ordinals import number_rows
from ledgerline.session import settle

START = datetime(2024, 1, 1)


def skewed(count, seed=7):
    """A third of the rows share one key, and a third of those are copies of one row."""
    random.seed(seed)
    found = []
    for i in range(count):
        if i % 9 == 0:
            found.append(("hot", START, 1.0))
        elif i % 3 == 0:
            found.append(("hot", START + timedelta(seconds=random.randrange(200_000)), float(i)))
        else:
            at = None if i % 50 == 1 else START + timedelta(seconds=random.randrange(500))
            found.append((f"k{random.randrange(40)}", at, float(i % 7)))
    return found


def test_number_rows_is_a_row_number(spark):
    data = skewed(1500)
    frame = spark.createDataFrame(data, "k string, at timestamp, v double")
    got = [tuple(r) for r in number_rows(frame, "k", "at", "rn", salts=4).collect()]
    assert Counter(r[:3] for r in got) == Counter(data)
    per_key = defaultdict(list)
    for k, at, v, rn in got:
        per_key[k].append((rn, at or datetime(1, 1, 1)))
    for numbered in per_key.values():
        numbered.sort()
        assert [rn for rn, _ in numbered] == list(range(1, len(numbered) + 1))
        assert [at for _, at in numbered] == sorted(at for _, at in numbered)


def test_restore_copies_in_chunks(spark):
    frame = spark.createDataFrame([("a", 7), ("b", 1), ("c", 5)], "k string, n bigint")
    got = [tuple(r) for r in restore_copies(frame, "n", "i", per_task=2).select("k", "i").collect()]
    assert sorted(got) == [("a", i) for i in range(1, 8)] + [("b", 1)] + [("c", i) for i in range(1, 6)]


def test_group_sizes(spark):
    data = skewed(900)
    frame = spark.createDataFrame(data, "k string, at timestamp, v double")
    sizes = Counter(k for k, _, _ in data)
    got = with_group_size(frame, "k", "size").collect()
    assert len(got) == len(data) and all(r["size"] == sizes[r["k"]] for r in got)


def test_distinct_per(spark):
    data = [("d1", "a", 1), ("d1", "a", 2), ("d1", None, 3), ("d1", None, 4), ("d2", "a", 5), ("d3", None, 6)]
    frame = spark.createDataFrame(data, "d string, k string, v bigint")
    got = distinct_per(frame, "d", F.col("k"), [F.sum("v").alias("v")], [F.sum("v").alias("v")])
    assert sorted(tuple(r) for r in got.collect()) == [("d1", 1, 10), ("d2", 1, 5), ("d3", 0, 6)]


def test_next_start_crosses_days(spark):
    times = [START, START + timedelta(seconds=5), START + timedelta(days=3), START + timedelta(days=3, hours=1)]
    frame = spark.createDataFrame([("A", t) for t in times] + [("B", START)], "c string, t timestamp")
    got = {(r.c, r.t): r.n for r in next_start(frame, "c", "t", "n", "2100-01-01 00:00:00").collect()}
    end = datetime(2100, 1, 1)
    assert got == {**{("A", a): b for a, b in zip(times, times[1:] + [end])}, ("B", START): end}


def brute_asof(left, points):
    out = []
    for i, k, at in left:
        best = None
        for pk, pt, v in points:
            if pk == k and at is not None and pt <= at and (best is None or pt > best[0]):
                best = (pt, v)
        out.append((i, best[1] if best else None))
    return sorted(out)


@pytest.mark.parametrize("spacing", [7, 900, 40_000])
@pytest.mark.parametrize("broadcast_rows", [0, 10**9])
def test_asof_equals_brute_force(spark, spacing, broadcast_rows):
    random.seed(spacing)
    points = [("A", datetime(1970, 1, 1), -1.0)]
    for k in ("B", "C"):
        times = sorted({random.randrange(spacing * 60) for _ in range(60)})
        points += [(k, START + timedelta(seconds=t), float(n)) for n, t in enumerate(times)]
    span = spacing * 70
    left = []
    for i in range(600):
        # A third of the rows meet in one minute.
        at = START + timedelta(seconds=span // 2) if i % 3 == 0 else START + timedelta(seconds=random.randrange(-50, span))
        left.append((i, random.choice(["A", "B", "C", "Z", None]), None if i % 97 == 0 else at))
    starts = spark.createDataFrame(points, "c string, s timestamp, v double")
    intervals = settle(next_start(starts, "c", "s", "e", "2100-01-01 00:00:00"), "t")
    frame = spark.createDataFrame(left, "i bigint, c string, at timestamp").withColumn("id", F.col("i"))
    got = asof_left_join(
        frame, intervals, "c", "at", "s", "e", {"v": "v"}, "id", broadcast_rows=broadcast_rows, salts=3
    )
    assert sorted((r.i, r.v) for r in got.collect()) == brute_asof(left, points)


def test_asof_strategy_follows_the_counted_size(spark):
    starts = spark.createDataFrame([("A", START + timedelta(seconds=i)) for i in range(50)], "c string, s timestamp")
    intervals = settle(next_start(starts, "c", "s", "e", "2100-01-01 00:00:00"), "t")
    left = settle(spark.createDataFrame([(1, "A", START)], "id bigint, c string, at timestamp"), "l")

    def plan(rows):
        joined = asof_left_join(left, intervals, "c", "at", "s", "e", {"s": "since"}, "id", broadcast_rows=rows)
        return joined._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(10_000) and "SortMergeJoin" in plan(10)


def test_bucket_width_follows_density(spark):
    def width(seconds):
        points = spark.createDataFrame([("A", START + timedelta(seconds=s)) for s in seconds], "c string, s timestamp")
        return choose_buckets(next_start(points, "c", "s", "e", "2100-01-01 00:00:00"), "c", "s", "e").width

    assert width([0]) == 86_400
    assert width(range(0, 86_400, 3_600)) == 86_400
    assert width(range(0, 86_400, 300)) == 3_600
    assert width(range(0, 7_200, 1)) == 60


def test_asof_with_no_points(spark):
    empty = settle(spark.createDataFrame([], "c string, s timestamp, e timestamp, v double"), "t")
    left = spark.createDataFrame([(1, "A", START)], "id bigint, c string, at timestamp")
    assert [r.v for r in asof_left_join(left, empty, "c", "at", "s", "e", {"v": "v"}, "id").collect()] == [None]


def test_left_lookup_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "z"), (5, "a")], "id bigint, k string")
    dim = spark.createDataFrame([("a", 10), ("b", 20)], "k string, v bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = left_lookup(left, dim, "k", "id", {"v": "value"}).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.id, r.value) for r in got) == [(1, 10), (2, None), (3, None), (4, None), (5, 10)]


def test_latest_per_key(spark):
    data = [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 5, "w"), ("a", 3, "b")]
    frame = spark.createDataFrame(data, "k string, t bigint, v string")
    got = sorted(tuple(r) for r in latest_per_key(frame, ["k"], "t").collect())
    assert got == [("a", 3, "y"), ("b", 5, "w")]


def test_combine_is_a_full_outer_join(spark):
    one = spark.createDataFrame([("d1", 1), ("d2", 2)], "d string, a bigint")
    two = spark.createDataFrame([("d2", 3.0), ("d3", None)], "d string, b double")
    got = sorted(tuple(r) for r in combine([one, two], ["d"], ["a", "b"]).collect())
    assert got == [("d1", 1, None), ("d2", 2, 3.0), ("d3", None, None)]


def test_checks(spark):
    frame = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3)], "k string, v bigint")
    checks = [Check("t", "k", "not_null"), Check("t", "v", "not_null"), Check("t", "k", "unique"), Check("t", "v", "unique")]
    results = run_checks({"t": frame}, checks)
    got = {(r.column_name, r.rule): r.failures for r in results.collect()}
    assert got == {("k", "not_null"): 2, ("v", "not_null"): 1, ("k", "unique"): 1, ("v", "unique"): 0}
    with pytest.raises(CheckFailure, match="t.k unique: 1"):
        require(results)
    require(run_checks({"t": frame.where("v = 1")}, checks))


def test_stray_times_add_a_handful_of_rows(spark):
    times = [START + timedelta(seconds=10 * i) for i in range(500)]
    stray = [datetime(1970, 1, 1, 0, 0, 1), datetime(1970, 1, 1, 0, 0, 2), datetime(2090, 1, 1)]
    left = settle(spark.createDataFrame([(i, "A", t + timedelta(seconds=3)) for i, t in enumerate(times)], "i bigint, c string, at timestamp"), "l")

    def openings(points):
        starts = spark.createDataFrame([("A", t) for t in points], "c string, s timestamp")
        spans = next_start(starts, "c", "s", "e", "2100-01-01 00:00:00").select(F.col("c").alias("_by"), F.col("s").alias("_start"), F.col("e").alias("_end"))
        buckets = choose_buckets(spans, "_by", "_start", "_end")
        used = left.select(F.col("c").alias("_by"), buckets.of(F.col("at")).alias("_bucket")).distinct()
        return asof.openings(used, spans.withColumn("_bucket", buckets.of(F.col("_start")))).count(), used.count()

    plain, strayed = openings(times), openings(times + stray)
    assert plain[1] == strayed[1] and strayed[0] <= plain[0] + len(stray)


def test_a_full_minute_is_cut_into_seconds(spark):
    points = [("A", START + timedelta(milliseconds=600 * i), float(i)) for i in range(100)]
    starts = spark.createDataFrame(points, "c string, s timestamp, v double")
    intervals = settle(next_start(starts, "c", "s", "e", "2100-01-01 00:00:00"), "t")
    assert choose_buckets(intervals, "c", "s", "e").cell == 1
    left = [(i, "A", START + timedelta(milliseconds=37 * i)) for i in range(1500)]
    frame = spark.createDataFrame(left, "i bigint, c string, at timestamp").withColumn("id", F.col("i"))
    for rows in (0, 10**9):
        got = asof_left_join(frame, intervals, "c", "at", "s", "e", {"v": "v"}, "id", broadcast_rows=rows)
        assert sorted((r.i, r.v) for r in got.collect()) == brute_asof(left, points)


def test_hot_buckets_are_salted(spark, monkeypatch):
    monkeypatch.setattr(asof, "HOT_ROWS", 50)
    points = [("A", START, 1.0), ("A", START + timedelta(seconds=30), 2.0)]
    intervals = settle(next_start(spark.createDataFrame(points, "c string, s timestamp, v double"), "c", "s", "e", "2100-01-01 00:00:00"), "t")
    left = [(i, "A", START + timedelta(seconds=i % 60)) for i in range(300)]
    frame = spark.createDataFrame(left, "i bigint, c string, at timestamp").withColumn("id", F.col("i"))
    got = asof_left_join(frame, intervals, "c", "at", "s", "e", {"v": "v"}, "id", broadcast_rows=0, salts=2)
    assert sorted((r.i, r.v) for r in got.collect()) == brute_asof(left, points)


def test_widths_are_nested():
    assert all(a % b == 0 for a, b in zip(asof.WIDTHS, asof.WIDTHS[1:]))


def test_bitmaps_count_exactly_and_merge(spark, rows):
    """Days that come later get bitmaps of their own; any set of days counts as the keys themselves do."""
    first = spark.range(4000).selectExpr("date_add(date'2024-01-01', cast(id % 5 as int)) day", "concat('k', id % 900) k")
    later = spark.range(3000).selectExpr("date_add(date'2024-01-04', cast(id % 4 as int)) day", "concat('k', id % 1300 + 500) k")
    later = later.unionByName(spark.sql("SELECT date'2024-01-04' day, cast(NULL AS string) k"))
    numbers = bitmaps.number_keys(first, "k")
    stored = bitmaps.day_bitmaps(first, "day", "k", numbers)
    numbers = bitmaps.number_keys(later, "k", numbers)
    assert numbers.count() == numbers.select("number").distinct().count() == 1800
    stored = stored.unionByName(bitmaps.day_bitmaps(later, "day", "k", numbers))
    every = first.unionByName(later)
    for days in (("2024-01-01", "2024-01-07"), ("2024-01-03", "2024-01-04"), ("2024-01-07", "2024-01-07")):
        within = F.col("day").between(*days)
        found = bitmaps.distinct_in(stored.where(within).withColumn("all", F.lit(1)), ["all"], "n").first().n
        assert found == every.where(within).select("k").where("k IS NOT NULL").distinct().count()
    assert bitmaps.distinct_in(stored.where("false"), ["day"], "n").count() == 0
    windows = {r.until.day: r.n for r in bitmaps.sliding(stored, "day", 3, "n").collect()}
    assert sorted(windows) == [1, 2, 3, 4, 5, 6, 7]
    assert windows[5] == every.where("day BETWEEN '2024-01-03' AND '2024-01-05' AND k IS NOT NULL").select("k").distinct().count()
