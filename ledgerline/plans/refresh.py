"""Rebuild of touched days: the batch tables kept by day, brought up to date with the rows that came in.

New rows say which days they touch, and every table passes on to its followers which of its days changed:

- transactions touch the days of all rows of their file day, as a key may begin to collide there;
- a user or promo that changed touches the days of its transactions;
- rates are spliced into the stored intervals: the days they start on and the last day with a rate before each are
  worked out again, no others; what differs there touches the days it spans;
- days of transactions touch the cancellations that look for their match there, and the marts of those days;
- cancellations touch the file days they came with and the marts of the days they happened on;
- a first purchase that moved restates the cohort of its user on every day the user was active.

Only touched days are read and written. ``created_days``, ``cancelled_days`` and ``rate_firsts`` are small tables that
name the days that files, cancellations and rates have rows of. Lists of days are what passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerline.operators.asof import first_of_days
from ledgerline.operators.checks import CORE_CHECKS, STOPPING, require, run_checks
from ledgerline.plans import dims, facts, marts, staging
from ledgerline.session import settle, settling
from ledgerline.sources.daytables import NO_DAY, WHOLE, DayTables, Run, day_text
from ledgerline.sources.keyed import BUCKETS, KeyedRows
from ledgerline.sources.loader import RawStore
from ledgerline.sources.schemas import CANCELLATIONS, EXCHANGE_RATES, PROMO_CODES, TEST_USERS, TRANSACTIONS, USERS
from ledgerline.streaming.sink import clear_tables, high_water


#: Tables that do not read each other are written at a time.
SIDE_BY_SIDE = 4


@dataclass(frozen=True)
class NewRows:
    """Raw rows that came in since the last run; None where nothing did. The first run needs all six, empty or not."""

    transactions: DataFrame | None = None
    cancellations: DataFrame | None = None
    exchange_rates: DataFrame | None = None
    users: DataFrame | None = None
    test_users: DataFrame | None = None
    promo_codes: DataFrame | None = None


def _values(rows: DataFrame, column: str) -> set[str]:
    """Distinct days; there are as many as the calendar has."""
    return {r[0] for r in rows.select(column).distinct().collect()}


def _shifted(days: Iterable[str], by: int) -> list[str]:
    return [(date.fromisoformat(d) + timedelta(by)).isoformat() for d in days if d != NO_DAY]


def _differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that only one of the two has."""
    return before.subtract(after).union(after.subtract(before))


def _unlike(before: DataFrame, after: DataFrame) -> DataFrame:
    """Spans ``since, until`` in which two sets of intervals give another rate; one that only ends elsewhere differs from there on."""
    both = before.union(after).groupBy("currency", "valid_from", "rate_key", "rate")
    ends = both.agg(F.count(F.lit(1)).alias("n"), F.min("valid_to").alias("first"), F.max("valid_to").alias("until"))
    return ends.select(F.when(F.col("n") > 1, F.col("first")).otherwise(F.col("valid_from")).alias("since"), "until").where("since < until")


def cancellation_day(key: Column) -> Column:
    """The file day as a cancellation's key has it."""
    day = F.substring_index(key, "#", 1)
    return F.when(day == "", NO_DAY).otherwise(day)


class DayStore:
    """All batch tables by day below one folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.tables = DayTables(spark, root)
        self.keyed = KeyedRows(spark, root, buckets)

    def read(self, name: str) -> DataFrame:
        return self.tables.snapshot().read(name).drop("day")

    def refresh(self, new: NewRows, run_ts: datetime | None = None, loads: DataFrame | None = None) -> dict[str, set[str]]:
        """Bring all tables up to date; the days of each table that were written.

        ``loads`` is noted with the run as what it has taken in.
        """
        run = self.tables.begin()
        with settling(self.spark):
            _Refresh(self, run, new, run_ts).build()
            if loads is not None:
                run.append("loads", loads.withColumn("day", F.lit(WHOLE)))
            run.publish()
        return run.written

    def refresh_store(self, store: RawStore, stream_root: str | None = None, run_ts: datetime | None = None) -> dict[str, set[str]]:
        """Take in the loads that are committed and not yet taken; then clear the stream tables up to here."""
        mark = high_water(self.spark, stream_root) if stream_root else None
        snapshot, commits = self.tables.snapshot(), store.commits()
        if snapshot.has("loads"):
            commits = settle(commits.join(snapshot.read("loads"), "load_id", "left_anti"), "new-loads")
        feeds = {
            "transactions": TRANSACTIONS,
            "cancellations": CANCELLATIONS,
            "exchange_rates": EXCHANGE_RATES,
            "users": USERS,
            "test_users": TEST_USERS,
            "promo_codes": PROMO_CODES,
        }
        rows = {name: store.table(feed, commits) for name, feed in feeds.items()}
        if snapshot.has("loads"):
            rows = {name: None if df.isEmpty() else df for name, df in rows.items()}
        written = self.refresh(NewRows(**rows), run_ts, commits)
        if stream_root:
            clear_tables(self.spark, stream_root, through=mark)
        return written


class _Refresh:
    def __init__(self, store: DayStore, run: Run, new: NewRows, run_ts: datetime | None):
        self.keyed, self.run, self.new, self.run_ts = store.keyed, run, new, run_ts

    def build(self) -> None:
        days = self.take_transactions()
        days |= self.take_users() | self.take_promos() | self.take_rates()
        first = self.new.transactions is not None and not self.run.has("fact_transactions")  # tables without rows are there too
        if days or first:
            self.build_facts(days)
        cancelled = self.take_cancellations(days)
        if days or cancelled or first:
            self.build_marts(days, days | cancelled)
        if days or first:
            self.build_cohorts(days)
        if days or "dim_promo_codes" in self.run.written:
            self.build_promo_usage()
        self.check()

    def _replace(self, tables: dict[str, tuple[DataFrame, Column | str, Iterable[str]]]) -> None:
        """Write tables that do not read each other: rows, what their day is, and the days that are replaced."""

        def one(name: str) -> None:
            rows, day, days = tables[name]
            self.run.replace(name, rows.withColumn("day", day_text(day) if isinstance(day, str) else day), days)

        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            list(pool.map(one, tables))

    # What came in, and the days of transactions it touches

    def take_transactions(self) -> set[str]:
        run = self.run
        if self.new.transactions is None:
            return set()
        came = self.keyed.insert(self.new.transactions, run.id)
        held = run.runs.setdefault("keyed", {})
        for day in came:
            held[day] = (*held.get(day, ()), run.id)
        own = self.keyed.rows(dict.fromkeys(came, (run.id,)), came)
        run.append("created_days", own.select(F.col("file_day").alias("day"), "created_day").distinct())
        return _values(run.read("created_days", came), "created_day")

    def take_users(self) -> set[str]:
        new = {"raw_users": self.new.users, "raw_test_users": self.new.test_users}
        return self._dimension(
            new, "dim_users", "user_uuid", ["is_test_user"], lambda: dims.users(self._raw("raw_users"), self._raw("raw_test_users"), self.run_ts)
        )

    def take_promos(self) -> set[str]:
        return self._dimension(
            {"raw_promo_codes": self.new.promo_codes},
            "dim_promo_codes",
            "promo_code_id",
            ["code", "max_uses", "expiry_date"],
            lambda: dims.promo_codes(staging.promo_codes(self._raw("raw_promo_codes")), self.run_ts),
        )

    def _raw(self, name: str) -> DataFrame:
        return self.run.read(name).drop("day")

    def _dimension(self, new: dict[str, DataFrame | None], name: str, key: str, fields: list[str], build) -> set[str]:
        """Rebuild a dimension that got rows; the days of transactions of keys whose fields changed."""
        run, known = self.run, self.run.has(name)
        came = {n: rows for n, rows in new.items() if rows is not None}
        if not came:
            return set()
        for n, rows in came.items():
            run.append(n, rows.withColumn("day", F.lit(WHOLE)))
        run.put(name, build())
        if not known:
            return set()
        columns = [key, *fields]
        changed = _differences(run.before.read(name).select(*columns), run.read(name).select(*columns)).select(key).distinct()
        held = run.runs.get("keyed", {})
        users = self.keyed.rows(held, held).select(key, "created_day")
        return _values(users.join(settle(changed, "changed-keys"), key, "left_semi"), "created_day")

    def take_rates(self) -> set[str]:
        run, known = self.run, self.run.has("rates")
        if self.new.exchange_rates is None:
            return set()
        staged = staging.exchange_rates(self.new.exchange_rates)
        staged = staged.where("source_file <> 'manual'") if known else staged  # the base rate is there already
        came = run.append("rates", staged.withColumn("day", day_text("ts")))
        starts = run.read("rates", came).where("ts IS NOT NULL").select("currency", F.col("ts").alias("valid_from"))
        firsts = first_of_days(starts, "currency", "valid_from").withColumn("day", day_text("_day"))
        run.replace("rate_firsts", firsts, came)
        index = run.read("rate_firsts")
        earlier = index.withColumn("before", F.lag("day").over(Window.partitionBy("currency").orderBy("day")))
        days = came | (_values(earlier.where(F.col("day").isin(sorted(came))), "before") - {None})
        spliced = dims.exchange_rates(run.read("rates", days), self.run_ts, index.drop("day"))
        run.replace("dim_exchange_rates", spliced.withColumn("day", day_text("valid_from")), days)
        if not known:
            return set()
        held = [x.read("dim_exchange_rates", days).where("valid_from < valid_to") for x in (run.before, run)]
        return self._days_spanned(_unlike(*held))

    def _days_spanned(self, spans: DataFrame) -> set[str]:
        """Days with transactions that spans of time reach into."""
        if not self.run.has("created_days"):
            return set()
        known = sorted(_values(self.run.read("created_days"), "created_day") - {NO_DAY})
        if not known:
            return set()
        first, last = (F.lit(d).cast("date") for d in (known[0], known[-1]))
        end = F.to_date(F.col("until") - F.expr("INTERVAL 1 MICROSECOND"))
        low, high = F.greatest(F.to_date("since"), first), F.least(end, last)
        days = spans.where(low <= high).select(F.explode(F.sequence(low, high)).alias("day")).distinct()
        return {r.day.isoformat() for r in days.collect()} & set(known)

    # Facts

    def build_facts(self, days: set[str]) -> None:
        run, wanted = self.run, sorted(days)
        index = run.read("created_days").where(F.col("created_day").isin(wanted))
        rows = self.keyed.rows(run.runs["keyed"], _values(index, "day"))
        flagged = staging.flagged_rows(rows).where(F.col("created_day").isin(wanted))
        fact = facts.transactions(flagged, run.read("dim_users"), run.read("dim_promo_codes"), self._rates(wanted), self.run_ts)
        self._replace(
            {
                "fact_transactions": (fact, "created_at", days),
                "dq_transactions_duplicate": (facts.quarantine(flagged, self.run_ts), "created_at", days),
                "staged_quality": (marts.staged_quality(flagged), "event_date", days),
            }
        )
        built = run.read("fact_transactions", days)
        self._replace(
            {
                "activity_hourly": (marts.hourly_activity(built), "created_hour", days),
                "promo_uses": (marts.promo_uses(built, "day"), F.col("day"), days),
                "user_days": (marts.user_days(built), "activity_date", days),
            }
        )

    def _rates(self, days: list[str]) -> DataFrame:
        """The intervals that reach into the span of the days."""
        rates, dated = self.run.read("dim_exchange_rates"), [d for d in days if d != NO_DAY]
        if not dated:
            return rates
        return rates.where((F.col("valid_to") > F.lit(dated[0])) & (F.col("valid_from") < F.date_add(F.lit(dated[-1]).cast("date"), 1)))

    def take_cancellations(self, days: set[str]) -> set[str]:
        """Match the cancellations that came in or may find other candidates now; the days these happened on."""
        run, came = self.run, set()
        if self.new.cancellations is not None:
            staged = staging.cancellations(self.new.cancellations)
            came = run.append("stg_cancellations", staged.withColumn("day", cancellation_day(F.col("cancellation_nk"))))
            on = run.read("stg_cancellations", came).select("day", day_text("cancelled_at").alias("cancelled_day")).distinct()
            run.replace("cancelled_days", on, came)
        if not run.has("cancelled_days"):
            return set()
        index = run.read("cancelled_days")
        came |= _values(index.where(F.col("cancelled_day").isin(_shifted(days, 1))), "day")
        if not came and run.has("fact_cancellations"):
            return set()
        cancelled = facts.cancellations(run.read("stg_cancellations", came), self.run_ts)
        run.replace("fact_cancellations", cancelled.withColumn("day", cancellation_day(F.col("cancellation_nk"))), came)
        happened = _values(index.where(F.col("day").isin(sorted(came))), "cancelled_day")
        targets = run.read("fact_transactions", _shifted(happened, -1)).drop("day")
        matched = facts.cancellation_matches(run.read("fact_cancellations", came).drop("day"), targets, self.run_ts)
        run.replace("fact_cancellation_matches", matched.withColumn("day", cancellation_day(F.col("cancellation_nk"))), came)
        return happened

    # Marts

    def build_marts(self, sold: set[str], days: set[str]) -> None:
        """``sold``: days whose transactions changed; ``days``: those or days whose cancellations did."""
        run = self.run
        index = run.read("cancelled_days").where(F.col("cancelled_day").isin(sorted(days)))
        matches = run.read("fact_cancellation_matches", _values(index, "day")).drop("day")
        matches = matches.where(day_text("cancelled_at").isin(sorted(days)))
        activity = run.read("activity_hourly", days).drop("day")
        staged, held = (run.read(n, days).drop("day") for n in ("staged_quality", "dq_transactions_duplicate"))
        sales = run.read("activity_hourly", sold).drop("day")
        self._replace(
            {
                "mart_revenue_daily": (marts.revenue_daily(activity, matches), "revenue_date", days),
                "mart_traffic_source_daily": (marts.traffic_source_daily(activity, matches), "event_date", days),
                "mart_cancellations_daily": (marts.cancellations_daily(activity, matches), "cancelled_date", days),
                "mart_data_quality_daily": (marts.quality_of(staged, held, activity, matches), "event_date", days),
                "mart_transactions_hourly": (marts.transactions_hourly(sales), "created_hour", sold),
                "mart_purchases_hourly": (marts.purchases_hourly(sales), "created_hour", sold),
                "mart_currency_daily": (marts.currency_daily(sales), "event_date", sold),
            }
        )

    def build_promo_usage(self) -> None:
        run = self.run
        if not run.has("promo_uses"):
            return
        counts = ["uses_total", "uses_completed_purchase", "uses_expired", "revenue_tgrk"]
        used = run.read("promo_uses").groupBy("promo_code_id", "is_test_user").agg(*[F.sum(c).alias(c) for c in counts])
        run.put("mart_promo_usage", marts.promo_usage_of(run.read("dim_promo_codes").drop("day"), used))

    def build_cohorts(self, days: set[str]) -> None:
        """Follow the first day of users who bought, or no longer did, on the touched days."""
        run = self.run
        after = run.read("user_days", days)
        if not run.has("first_days"):
            first = after.groupBy("user_uuid").agg(F.min("activity_date").alias("first"))
            run.replace("first_days", first.withColumn("day", day_text("first")), days)
            restated: set[str] = set()
        else:
            moved = settle(self._moved(after, days), "moved-firsts")
            ends = _values(moved.select(day_text("old").alias("d")).union(moved.select(day_text("new"))), "d") - {NO_DAY}
            stayed = run.before.read("first_days", ends).join(moved, "user_uuid", "left_anti")
            now = moved.where("new IS NOT NULL").select("user_uuid", F.col("new").alias("first"), day_text("new").alias("day"))
            run.replace("first_days", stayed.select(*now.columns).union(now), ends)
            restated = _values(run.read("user_days").join(moved.where("old IS NOT NULL"), "user_uuid", "left_semi"), "day")
        wanted = days | restated
        active = run.read("user_days", wanted).drop("day")
        firsts = run.read("first_days").select("user_uuid", F.col("first").alias("cohort_date"))
        built = marts.cohorts_of(active.join(firsts, "user_uuid"))
        run.replace("mart_user_cohorts", built.withColumn("day", day_text("activity_date")), wanted)

    def _moved(self, after: DataFrame, days: set[str]) -> DataFrame:
        """Users whose first day changed: ``user_uuid, old, new``."""
        run, touched = self.run, sorted(days)
        before = run.before.read("user_days", days)
        here = after.groupBy("user_uuid").agg(F.min("activity_date").alias("here"))
        seen = before.select("user_uuid").union(after.select("user_uuid")).distinct()
        known = run.before.read("first_days").select("user_uuid", F.col("first").alias("old"))
        state = settle(seen.join(known, "user_uuid", "left").join(here, "user_uuid", "left"), "user-firsts")
        # Whoever had the first day among the touched ones and lacks it now may have any later day as first.
        lost = F.coalesce(day_text("old").isin(touched) & (F.col("here").isNull() | (F.col("here") > F.col("old"))), F.lit(False))
        gone = state.where(lost).select("user_uuid")
        later = run.read("user_days").join(gone, "user_uuid", "left_semi").groupBy("user_uuid").agg(F.min("activity_date").alias("later"))
        found = state.join(later, "user_uuid", "left")
        new = F.when(lost, F.col("later")).otherwise(F.least("old", "here"))
        return found.select("user_uuid", "old", new.alias("new")).where("NOT old <=> new")

    def check(self) -> None:
        """The checks of published tables on what this run has written."""
        checked = sorted({c.table for c in CORE_CHECKS} & self.run.written.keys())
        if checked:
            require(run_checks({name: self.run.read(name, self.run.written[name]) for name in checked}, only=STOPPING))
