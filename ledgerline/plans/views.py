"""Names for SQL: published tables, staging and the rolling views as temp views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from ledgerline.functions.times import utc
from ledgerline.plans import rolling
from ledgerline.plans.rebuild import CORE, MARTS, Published, warehouse_of
from ledgerline.sources.loader import RawStore
from ledgerline.sources.schemas import FEEDS, STREAM_TABLES
from ledgerline.streaming import sink
from ledgerline.streaming.feeds import SOURCE

STAGING = [
    "stg_transactions",
    "stg_cancellations",
    "stg_exchange_rates",
    "stg_users",
    "stg_promo_codes",
]


def register_raw(store: RawStore) -> list[str]:
    """Raw tables and the load log by name."""
    commits = store.commits()
    for feed in FEEDS:
        store.table(feed, commits).createOrReplaceTempView(feed.table)
    store.load_log().createOrReplaceTempView("load_log")
    return [feed.table for feed in FEEDS] + ["load_log"]


def register_staging(store: RawStore) -> list[str]:
    """Staging as views over the raw tables as of now; register again after a load.

    The keys that collide are counted and stored here, so this runs jobs.
    """
    warehouse = warehouse_of(store)
    for name in STAGING:
        getattr(warehouse, name).createOrReplaceTempView(name)
    return STAGING


def register_published(published: Published) -> list[str]:
    """Core tables and marts of the current run."""
    names = [*CORE, *MARTS]
    for name in names:
        published.table(name).createOrReplaceTempView(name)
    return names


def _latest_sql(root: str, table: str) -> str:
    """The last arrived row per key of the batches that are there when it is read, merged ones and others."""
    schema, key = STREAM_TABLES[table]
    rest = [c for c in schema.names if c not in key and c != "loaded_at"]
    picked = ", ".join(c if c in key else f"row.{c} AS {c}" for c in schema.names)
    types = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields)
    manifests = f"parquet.`{root}/merges/{table}`"
    merges = f"(SELECT run, batch_id FROM {manifests} WHERE number = (SELECT max(number) FROM {manifests}))"
    return f"""
        SELECT {picked} FROM (
            SELECT {", ".join(key)}, max(struct(loaded_at, {", ".join(rest)})) AS row
            FROM (
                SELECT {types}, CAST(batch_id AS STRING) AS batch_id FROM parquet.`{root}/{table}` l
                LEFT ANTI JOIN {merges} m ON CAST(l.batch_id AS STRING) = m.batch_id
                UNION ALL
                SELECT {types}, batch_id FROM parquet.`{root}/merged/{table}` r LEFT SEMI JOIN {merges} m ON r.run = m.run
            ) b
            LEFT ANTI JOIN parquet.`{root}/cleared/{table}/*` c ON b.batch_id = c.batch_id
            WHERE {{window}} GROUP BY {", ".join(key)})"""


def register_stream(spark: SparkSession, root: str, as_of: datetime | None = None) -> list[str]:
    """Stream tables, latest row per key, and the rolling views over them, all live.

    The views are kept as SQL text over the folders, so that each read lists the
    files anew: batches written later show, and cleared ones do not, however
    early the views were registered.
    """
    sink.prepare(spark, root)
    for name in STREAM_TABLES:
        text = _latest_sql(root, name).format(window="true")
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {text}")
    moment = "current_timestamp()" if as_of is None else f"TIMESTAMP '{utc(as_of):%Y-%m-%d %H:%M:%S.%f} UTC'"
    since = f"{moment} - {rolling.WINDOW}"
    window = f"loaded_at >= {since}" + ("" if as_of is None else f" AND loaded_at <= {moment}")
    recent = {name: f"({_latest_sql(root, name).format(window=window)})" for name in STREAM_TABLES}
    frame = f"{since} AS window_started_at, {moment} AS calculated_at, '{SOURCE}' AS source"
    paid = "is_purchase = 1 AND is_completed = 1"
    shares = ", ".join(
        f"coalesce(try_divide({c}_count, transaction_count), 0.0D) AS {c}_share"
        for c in ("empty_user", "negative_amount", "zero_amount")
    )
    feeds = zip(("transaction", "cancellation", "exchange_rate"), STREAM_TABLES, strict=True)
    tagged = " UNION ALL ".join(f"SELECT loaded_at, source, '{kind}' AS event_type FROM {recent[name]}" for kind, name in feeds)
    flags = "count_if(is_negative_amount = 1) AS negative_amount_count, count_if(is_zero_amount = 1) AS zero_amount_count"
    views = {
        "mart_rt_current_hour_metrics": f"""
            SELECT date_trunc('hour', {moment}) AS current_hour, {frame}, count(*) AS transaction_count,
                   count_if(is_purchase = 1) AS purchase_type_count, count_if(is_completed = 1) AS completed_count,
                   count_if({paid}) AS completed_purchase_count, currency, sum(amount) AS amount_original,
                   coalesce(sum(amount) FILTER (WHERE {paid}), 0.0D) AS completed_purchase_amount_original, {flags},
                   count_if(is_empty_user = 1) AS empty_user_count, max(loaded_at) AS last_loaded_at
            FROM {recent["rt_transactions"]} GROUP BY currency""",
        "mart_rt_events_per_minute": f"""
            SELECT date_trunc('minute', loaded_at) AS event_minute, source, event_type, count(*) AS event_count
            FROM ({tagged}) GROUP BY 1, 2, 3""",
        "mart_rt_data_quality_last_60m": f"""
            SELECT *, {shares} FROM (
                SELECT {frame}, count(*) AS transaction_count, count_if(is_empty_user = 1) AS empty_user_count, {flags},
                       count_if(is_transaction_duplicate = 1) AS duplicate_transaction_count
                FROM {recent["rt_transactions"]})""",
    }
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {text}")
    return [*STREAM_TABLES, *views]
