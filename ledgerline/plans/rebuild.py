"""Full rebuild: build every table under a run id, check, publish, clear the stream tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ledgerline.functions.times import utc
from ledgerline.operators.checks import STOPPING, require, run_checks
from ledgerline.plans import facts
from ledgerline.plans.warehouse import Warehouse
from ledgerline.session import configure, settling
from ledgerline.sources.loader import RawStore
from ledgerline.sources.schemas import (
    CANCELLATIONS,
    EXCHANGE_RATES,
    PROMO_CODES,
    TEST_USERS,
    TRANSACTIONS,
    USERS,
)
from ledgerline.streaming.sink import clear_tables, high_water

# Core tables with the column their files are sorted by, then marts.
CORE = {
    "dim_users": "user_uuid",
    "dim_promo_codes": "promo_code_id",
    "dim_exchange_rates": "valid_from",
    "fact_transactions": "created_at",
    "fact_cancellations": "cancellation_nk",
    "fact_cancellation_matches": "cancellation_nk",
    "dq_transactions_duplicate": "transaction_nk",
}
MARTS = [
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
# What the warehouse calls the stored form of a table that several others read.
STORED = {"fact_transactions": "stored_transactions", "fact_cancellation_matches": "stored_matches"}
PUBLISHED = StructType(
    [
        StructField("run_id", StringType()),
        StructField("published_at", TimestampType()),
        StructField("sequence", LongType()),
    ]
)
#: Published runs whose tables are kept; readers of the current one and those before it are not disturbed.
KEPT_RUNS = 3


class Published:
    """Published tables under one folder: ``runs/<run id>/<table>`` and a list of runs.

    A run becomes visible with its row in ``published``; a failed one never does.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def write(self, run_id: str, name: str, df: DataFrame, sort: str | None = None, by: str | None = None) -> DataFrame:
        """Store a table, sorted by a column within its files, in a folder for each value of ``by`` if given."""
        path = f"{self.root}/runs/{run_id}/{name}"
        order = [c for c in (by, sort) if c]
        writer = (df.sortWithinPartitions(*order) if order else df).write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def runs(self) -> list[str]:
        """Published runs in the order of their publication."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/published")
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return []
        rows = self.spark.read.schema(PUBLISHED).parquet(f"{self.root}/published")
        return [r.run_id for r in rows.orderBy("sequence", "published_at", "run_id").collect()]

    def publish(self, run_id: str, at: datetime) -> None:
        """Make a run the current one, whatever time ``at`` it stands for."""
        row = self.spark.createDataFrame([(run_id, utc(at), len(self.runs()) + 1)], PUBLISHED)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/published")

    def current(self) -> str:
        return self.runs()[-1]

    def drop(self, run_id: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/runs/{run_id}")
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def retire(self, kept: int = KEPT_RUNS) -> int:
        """Delete the tables of all but the last ``kept`` published runs."""
        old = self.runs()[:-kept]
        for run_id in old:
            self.drop(run_id)
        return len(old)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/runs/{self.current()}/{name}")


def warehouse_of(store: RawStore, run_ts: datetime | None = None, **options) -> Warehouse:
    """The batch tables over the committed raw tables, all as of the same commits."""
    commits = store.commits()
    return Warehouse(
        transactions=store.table(TRANSACTIONS, commits),
        cancellations=store.table(CANCELLATIONS, commits),
        exchange_rates=store.table(EXCHANGE_RATES, commits),
        users=store.table(USERS, commits),
        test_users=store.table(TEST_USERS, commits),
        promo_codes=store.table(PROMO_CODES, commits),
        run_ts=run_ts,
        **options,
    )


def rebuild(
    warehouse: Warehouse, published: Published, stream_root: str | None = None, mark: frozenset[str] | int | None = None
) -> str:
    """Build, check and publish all tables; then clear the stream tables.

    Tables are stored in dependency order and read back by the next ones, so
    the fact is computed once. ``mark`` is what the clear may take; without one
    it is taken here, first of all. What was settled on the way is deleted at
    the end, as are the tables of a run that failed and of runs long replaced.
    """
    spark, run_id = published.spark, uuid.uuid4().hex
    if stream_root and mark is None:
        mark = high_water(spark, stream_root)
    built: dict[str, DataFrame] = {}
    try:
        with settling(spark):
            warehouse.store_keyed()
            for name, sort in CORE.items():
                if name == "fact_transactions":
                    built[name] = published.write(run_id, name, facts.by_day(warehouse.fact_transactions), sort, facts.BY_DAY)
                else:
                    built[name] = published.write(run_id, name, getattr(warehouse, name), sort)
                setattr(warehouse, name, built[name])
                if name in STORED:
                    setattr(warehouse, STORED[name], built[name])
            warehouse.activity = published.write(run_id, "activity_hourly", warehouse.activity)
            for name in MARTS:
                published.write(run_id, name, getattr(warehouse, name))
            require(run_checks(built, only=STOPPING))
    except Exception:
        published.drop(run_id)
        raise
    published.publish(run_id, warehouse.run_ts or datetime.now(timezone.utc))
    published.retire()
    if stream_root:
        clear_tables(spark, stream_root, through=mark)
    return run_id


def rebuild_store(
    store: RawStore, published: Published, stream_root: str | None = None, run_ts: datetime | None = None
) -> str:
    """The hourly run. The stream's mark is taken before the raw tables are looked at, so a batch is only
    cleared when the files that hold its events can be in the rebuild."""
    mark = high_water(published.spark, stream_root) if stream_root else None
    return rebuild(warehouse_of(store, run_ts), published, stream_root, mark)
