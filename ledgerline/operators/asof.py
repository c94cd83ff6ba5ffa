"""LEFT as-of join over validity intervals.

With few keys (a handful of currencies) an equi join on the key alone would put
a third of the rows in one task and scan every interval of the key per row.
Both sides therefore get a time bucket as second equi key. A bucket holds the
intervals that start in it, and one more: the one that is running when the
bucket opens. Openings are made only for buckets that some left row falls in,
so the table is linear in intervals and rows, however far apart stray times
are. The width is the widest from a day to a minute that keeps the fullest
bucket small; where a minute is too full it is a second. A table whose size is counted to be small is broadcast, and the
left side does not move at all; beyond that both sides are shuffled on (key,
bucket), and only buckets counted as hot are salted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.session import BROADCAST_ROWS, settle

WIDTHS = [86_400, 21_600, 3_600, 600, 60]
FULLEST_BUCKET = 32
# Left rows of one bucket that a task takes before the bucket is split.
HOT_ROWS = 100_000
# Buckets that are walked through in one window for their openings.
STRETCH = 4_096


def first_of_days(points: DataFrame, by: str, at: str) -> DataFrame:
    """The first point of each key and day: ``by, _day, _first``."""
    return points.groupBy(by, F.to_date(at).alias("_day")).agg(F.min(at).alias("_first"))


def next_start(points: DataFrame, by: str, at: str, out: str, end: str, firsts: DataFrame | None = None) -> DataFrame:
    """Add the following distinct time per ``by``; ``end`` after the last one.

    ``points`` holds one row per (by, at). The lookahead runs per day, and per
    key over the first point of each day, so no task sorts a whole key. When
    ``points`` are whole days of some more, ``firsts`` has the first points of all.
    """
    daily = points.withColumn("_day", F.to_date(at))
    in_day = Window.partitionBy(by, "_day").orderBy(at)
    over_days = Window.partitionBy(by).orderBy("_day")
    firsts = first_of_days(points, by, at) if firsts is None else firsts
    openings = firsts.select(by, "_day", F.lead("_first").over(over_days).alias("_next_day"))
    following = F.coalesce(F.col("_same_day"), F.col("_next_day"), F.lit(end).cast("timestamp"))
    return (
        daily.withColumn("_same_day", F.lead(at).over(in_day))
        .join(openings, [by, "_day"])
        .withColumn(out, following)
        .drop("_day", "_same_day", "_next_day")
    )


@dataclass(frozen=True)
class Buckets:
    """Bucket width in seconds, and the number of intervals that start in any.

    Where even a minute is too full, the buckets are single seconds (``cell``).
    """

    width: int
    rows: int
    cell: int

    def of(self, moment: Column) -> Column:
        return F.floor(F.unix_seconds(moment) / self.cell)


def choose_buckets(intervals: DataFrame, by: str, start: str, end: str) -> Buckets:
    """Read the shape of the interval table in one job that returns one row per level."""
    intervals = intervals.where(F.col(start) < F.col(end))
    levels = [f"_w{w}" for w in WIDTHS]
    second = F.unix_seconds(start)
    smallest = intervals.groupBy(F.col(by), F.floor(second / WIDTHS[-1]).alias(levels[-1])).agg(F.count(F.lit(1)).alias("n"))
    wider = [F.floor(F.col(levels[-1]) * WIDTHS[-1] / w).alias(name) for w, name in zip(WIDTHS, levels)]
    groups = smallest.select(F.col(by), *wider, "n").rollup(by, *levels)
    summed = groups.agg(F.grouping_id().alias("level"), F.sum("n").alias("n"))
    # grouping_id has one bit per rolled-up column, the narrowest width lowest.
    fullest = {r["level"]: r["n"] for r in summed.groupBy("level").agg(F.max("n").alias("n")).collect()}
    if not fullest:
        return Buckets(WIDTHS[0], 0, WIDTHS[0])
    per_width = {w: fullest[2 ** (len(WIDTHS) - 1 - i) - 1] for i, w in enumerate(WIDTHS)}
    width = next((w for w in WIDTHS if per_width[w] <= FULLEST_BUCKET), WIDTHS[-1])
    cell = width if per_width[width] <= FULLEST_BUCKET else 1
    return Buckets(width, fullest[2 ** (len(WIDTHS) + 1) - 1], cell)


def openings(used: DataFrame, live: DataFrame) -> DataFrame:
    """The interval that is running when each of the ``used`` (_by, _bucket) opens.

    Of each bucket the last interval matters. Buckets of a key are walked in
    stretches, and stretches by what the ones before them end with.
    """
    fields = [c for c in live.columns if c not in ("_by", "_bucket")]
    whole = F.struct(*fields)
    last = live.groupBy("_by", "_bucket").agg(F.max_by(whole, "_start").alias("_last"))
    marked = last.withColumn("_used", F.lit(0)).unionByName(used.withColumn("_used", F.lit(1)), allowMissingColumns=True)
    stops = marked.groupBy("_by", "_bucket").agg(F.max("_used").alias("_used"), F.max("_last").alias("_last"))
    stops = stops.withColumn("_stretch", F.floor(F.col("_bucket") / STRETCH))
    inner = Window.partitionBy("_by", "_stretch").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("_by").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = stops.where("_last IS NOT NULL").groupBy("_by", "_stretch").agg(F.max_by("_last", "_bucket").alias("_end_of"))
    every = stops.select("_by", "_stretch").distinct().join(ends, ["_by", "_stretch"], "left")
    carried = every.withColumn("_before", F.last("_end_of", ignorenulls=True).over(outer)).drop("_end_of")
    walked = stops.withColumn("_running", F.last("_last", ignorenulls=True).over(inner)).where("_used = 1")
    found = walked.join(carried, ["_by", "_stretch"]).withColumn("_open", F.coalesce("_running", "_before"))
    return found.where("_open IS NOT NULL").select("_by", "_bucket", *[F.col(f"_open.{c}").alias(c) for c in fields])


def asof_left_join(
    left: DataFrame,
    intervals: DataFrame,
    by: str,
    at: str,
    start: str,
    end: str,
    fields: dict[str, str],
    spread: str,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = 16,
    times: DataFrame | None = None,
) -> DataFrame:
    """Add ``fields`` of the interval that holds ``at`` for the same ``by``.

    ``intervals`` should be a stored table, as its shape is read first. They
    must not overlap per ``by``; empty ones never match. Which buckets are used
    is read from ``times``, a frame with at least the (by, at) of ``left`` that is
    cheaper to read, or from ``left`` itself.
    """
    live = intervals.select(
        F.col(by).alias("_by"),
        F.col(start).alias("_start"),
        F.col(end).alias("_end"),
        *[F.col(name).alias(out) for name, out in fields.items()],
    ).where("_start < _end")
    buckets = choose_buckets(live, "_by", "_start", "_end")
    live = live.withColumn("_bucket", buckets.of(F.col("_start")))
    rows = left.withColumn("_slot", buckets.of(F.col(at)))
    seen = (left if times is None else times).select(F.col(by).alias("_by"), buckets.of(F.col(at)).alias("_bucket"))
    used = seen.where("_by IS NOT NULL AND _bucket IS NOT NULL").groupBy("_by", "_bucket")
    used = settle(used.agg(F.count(F.lit(1)).alias("_rows")), "asof-buckets")
    side = live.unionByName(openings(used.drop("_rows"), live))
    holds = (
        (F.col(by) == F.col("_by"))
        & (F.col("_slot") == F.col("_bucket"))
        & (F.col(at) >= F.col("_start"))
        & (F.col(at) < F.col("_end"))
    )
    if buckets.rows + used.count() <= broadcast_rows:
        joined = rows.join(F.broadcast(side), holds, "left")
    else:
        hot = used.where(F.col("_rows") > HOT_ROWS).select(
            F.col("_by").alias("_hot_by"),
            F.col("_bucket").alias("_hot_bucket"),
            (F.col("_rows") / HOT_ROWS + salts).cast("bigint").alias("_parts"),
        )
        hot = settle(hot, "asof-hot")
        parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
        added = ["_hot_by", "_hot_bucket", "_parts"]
        rows = rows.join(hot, (F.col(by) == F.col("_hot_by")) & (F.col("_slot") == F.col("_hot_bucket")), "left")
        rows = rows.withColumn("_part", F.pmod(F.xxhash64(spread), parts)).drop(*added)
        side = side.join(hot, (F.col("_by") == F.col("_hot_by")) & (F.col("_bucket") == F.col("_hot_bucket")), "left")
        every = F.sequence(F.lit(0).cast("bigint"), parts - 1)
        side = side.withColumn("_salt", F.explode(every)).drop(*added)
        joined = rows.join(side.hint("merge"), holds & (F.col("_part") == F.col("_salt")), "left")
    return joined.drop("_by", "_start", "_end", "_bucket", "_slot", "_part", "_salt")
