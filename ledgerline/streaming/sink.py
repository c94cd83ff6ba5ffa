"""Stream tables: one query writes all feeds, batch by batch, exactly once.

Each micro-batch goes to its own folder ``<table>/batch_id=<query>-N``, overwritten
when the batch is replayed after a failure; the query's id keeps the batches of
another query apart. The rows of a batch arrived together, so the rolling views
skip older files by their arrival-time statistics.

A clear first only notes batches as cleared, which hides them from readers; their
files go with the next clear, so that a reader that has begun can end.

Small batches are merged by ``merge_batches`` (see ``merges``); a row keeps the batch it came in, so a clear
hides the same rows before and after.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.operators.latest import latest_per_key
from ledgerline.plans.rolling import recent
from ledgerline.sources.schemas import STREAM_TABLES
from ledgerline.streaming import merges
from ledgerline.streaming.feeds import FEEDS, observed, parse_messages

# The flush interval of the stream sink.
FLUSH_INTERVAL = "2 seconds"
ROWS_PER_FILE = 1_000_000
CLEARED = StructType([StructField("batch_id", StringType())])


def _batch_name(spark: SparkSession, batch_id: int) -> str:
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}" if query else str(batch_id)


def write_feeds(parsed: DataFrame, batch_id: int, root: str) -> None:
    """Write one parsed micro-batch to the three tables, in files of a fair size; safe to repeat."""
    name = _batch_name(parsed.sparkSession, batch_id)
    prepare(parsed.sparkSession, root)
    parsed.persist()
    try:
        files = -(-parsed.count() // ROWS_PER_FILE) or 1
        for table, mapper in FEEDS.items():
            rows = mapper(parsed).coalesce(files).sortWithinPartitions(*STREAM_TABLES[table][1])
            rows.write.mode("overwrite").parquet(f"{root}/{table}/batch_id={name}")
    finally:
        parsed.unpersist()


def prepare(spark: SparkSession, root: str) -> None:
    """Empty files that give each table and its list of cleared batches a schema from the start."""
    for table, (schema, _) in STREAM_TABLES.items():
        for path, kind in ((f"{root}/{table}/batch_id=none", schema), (f"{root}/cleared/{table}/none", CLEARED)):
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
                spark.createDataFrame([], kind).coalesce(1).write.mode("overwrite").parquet(path)
    merges.prepare(spark, root)


def start_feeds(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    arrival: str | None = None,
    once: bool = False,
    interval: str = FLUSH_INTERVAL,
) -> StreamingQuery:
    """Run the feeds until stopped, or over what is there now with ``once``."""
    parsed = observed(parse_messages(messages, arrival))
    writer = (
        parsed.writeStream.queryName("ledgerline-feeds")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_feeds(batch, batch_id, root))
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Every stored row of a stream table that is not cleared; empty when nothing was written yet."""
    stored = merges.stored_schema(table)
    # the manifest first: a merge that ends in between then shows neither its run nor its absence of batches
    merged = merges.current(spark, root, table)
    runs = merges.read_runs(spark, root, table, merged)
    gone = _cleared(spark, root, table)
    rows = spark.createDataFrame([], stored)
    if _folder(spark, f"{root}/{table}")[1]:
        rows = spark.read.schema(stored).parquet(f"{root}/{table}")
        hidden = sorted({*gone, *merged.all_batches()})
        rows = rows.where(~F.col("batch_id").isin(hidden)) if hidden else rows
    if runs is not None:
        rows = rows.unionByName(runs.where(~F.col("batch_id").isin(gone)) if gone else runs)
    return rows


def merge_batches(spark: SparkSession, root: str) -> int:
    """Merge the small batches of all stream tables; how many batches left their folders."""
    return sum(merges.merge_table(spark, root, t, frozenset(_cleared(spark, root, t)), ROWS_PER_FILE) for t in STREAM_TABLES)


def latest(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The stream table with the last arrived row per key."""
    return collapse(read_table(spark, root, table), table)


def collapse(rows: DataFrame, table: str) -> DataFrame:
    schema, key = STREAM_TABLES[table]
    return latest_per_key(rows.select(*schema.names), key, "loaded_at")


def latest_recent(spark: SparkSession, root: str, table: str, as_of: datetime | None = None) -> DataFrame:
    """Last arrived row per key among the last 60 minutes; older hours are not read.

    A key whose last row is older has no row in the window at all, so filtering
    first gives the same rows as collapsing the whole table first.
    """
    return collapse(recent(read_table(spark, root, table), as_of), table)


def _folder(spark: SparkSession, path: str):
    """Hadoop file system, and the batch folders below the path."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    if not fs.exists(where):
        return fs, []
    found = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith("batch_id=")]
    return fs, [p for p in found if p.getName() != "batch_id=none"]


def _cleared(spark: SparkSession, root: str, table: str) -> list[str]:
    """Batches noted as cleared that files still hold: those of one clear, and some of merged runs."""
    path = f"{root}/cleared/{table}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return []
    notes = spark.read.schema(CLEARED).option("recursiveFileLookup", "true").parquet(path)
    return sorted(r.batch_id for r in notes.distinct().collect())


def live_batches(spark: SparkSession, root: str, table: str) -> list[str]:
    gone = set(_cleared(spark, root, table))
    names = {p.getName().split("=", 1)[1] for p in _folder(spark, f"{root}/{table}")[1]}
    return sorted((names | merges.current(spark, root, table).all_batches()) - gone)


def high_water(spark: SparkSession, root: str) -> frozenset[str] | int:
    """The batches stored so far, -1 for none: what a later clear may take."""
    return frozenset(n for table in STREAM_TABLES for n in live_batches(spark, root, table)) or -1


def clear_tables(spark: SparkSession, root: str, through: frozenset[str] | int | None = None) -> int:
    """Hide the stored batches of all stream tables, those of the mark ``through`` when given.

    A batch that the stream is writing right now is not in a mark taken before
    the rebuild, so it is not touched. Files of batches hidden by the clear
    before this one are deleted.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    prepare(spark, root)
    hidden = 0
    for table in STREAM_TABLES:
        names = [n for n in live_batches(spark, root, table) if through is None or (through != -1 and n in through)]
        before = _cleared(spark, root, table)
        notes = jvm.org.apache.hadoop.fs.Path(f"{root}/cleared/{table}")
        fs = notes.getFileSystem(conf)
        old = [s.getPath() for s in fs.listStatus(notes) if s.getPath().getName() != "none"]
        # a run that holds other batches too keeps the cleared ones until it is rewritten
        kept = merges.drop_cleared(spark, root, table, frozenset(before)) if before else frozenset()
        if names or kept:
            note = spark.createDataFrame([(n,) for n in sorted({*names, *kept})], CLEARED).coalesce(1)
            note.write.parquet(f"{root}/cleared/{table}/{uuid.uuid4().hex}")
        for name in before:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/batch_id={name}"), True)
        for path in old:
            fs.delete(path, True)
        hidden += len(names)
    return hidden
