"""Merged stream batches: contents, readers that go on, clears, sizes."""

from __future__ import annotations

import shutil
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.plans.views import register_stream
from ledgerline.session import with_settings
from ledgerline.sources.schemas import STREAM_TABLES
from ledgerline.streaming import feeds, merges, sink
from ledgerline.trial import catalog
from test_streaming import WHEN, parsed, tx

TABLE = "rt_transactions"


@pytest.fixture
def feed(spark, tmp_path):
    """Batches of one row each; the row's id is the batch's number."""
    root = f"{tmp_path}/tables"

    sink.prepare(spark, root)

    class Feed:
        def write(self, numbers):
            for n in numbers:
                rows = feeds.transactions(parsed(spark, tx(transaction_id=n), arrival=WHEN + timedelta(minutes=n)))
                rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/{TABLE}/batch_id={n}")

        def copy(self, numbers):
            """Many batches at small cost: the last stored one under other names."""
            for n in numbers:
                shutil.copytree(f"{root}/{TABLE}/batch_id=100000", f"{root}/{TABLE}/batch_id={n}")

        def ids(self):
            register_stream(spark, root)
            found = sorted(r.transaction_id for r in sink.read_table(spark, root, TABLE).collect())
            assert sorted(r.transaction_id for r in spark.table(TABLE).collect()) == sorted(set(found))
            return found

    made = Feed()
    made.root = root
    return made


def test_merge_changes_no_row_and_a_reader_goes_on(spark, feed):
    feed.write(range(4))
    opened = sink.read_table(spark, feed.root, TABLE)
    assert sink.merge_batches(spark, feed.root) == 3  # the last batch stays
    assert feed.ids() == [0, 1, 2, 3] == sorted(r.transaction_id for r in opened.collect())
    assert sink.live_batches(spark, feed.root, TABLE) == ["0", "1", "2", "3"]
    feed.write([4])
    sink.merge_batches(spark, feed.root)
    assert merges.folders(spark, f"{feed.root}/{TABLE}", "batch_id=0") == []
    assert feed.ids() == [0, 1, 2, 3, 4]
    assert sink.merge_batches(spark, feed.root) == 0


def test_a_replayed_last_batch_overwrites_itself(spark, feed):
    feed.write(range(3))
    sink.merge_batches(spark, feed.root)
    feed.write([2])
    assert feed.ids() == [0, 1, 2]


def test_clear_is_exact_after_a_merge(spark, feed):
    feed.write(range(2))
    mark = sink.high_water(spark, feed.root)
    feed.write([2, 3])
    sink.merge_batches(spark, feed.root)
    sink.clear_tables(spark, feed.root, through=mark)
    assert feed.ids() == [2, 3] and sink.live_batches(spark, feed.root, TABLE) == ["2", "3"]
    sink.clear_tables(spark, feed.root, through=-1)  # deletes what was hidden; the run still holds rows of it
    assert feed.ids() == [2, 3]
    feed.write([4, 5, 6])
    sink.merge_batches(spark, feed.root)  # rewrites the run without them
    assert feed.ids() == [2, 3, 4, 5, 6]
    sink.clear_tables(spark, feed.root)
    assert feed.ids() == []
    sink.clear_tables(spark, feed.root)
    assert feed.ids() == [] and merges.current(spark, feed.root, TABLE).batches == {}


def test_a_clear_during_a_merge_makes_it_give_up(spark, feed, monkeypatch):
    feed.write(range(3))
    sink.clear_tables(spark, feed.root, through=frozenset({"0"}))
    read = merges.current
    seen = []

    def current(*args):
        if len(seen) == 1:
            seen.append(args)
            sink.clear_tables(spark, feed.root, through=-1)
        found = read(*args)
        seen.append(args)
        return found

    monkeypatch.setattr(merges, "current", current)
    with pytest.raises(merges.Outdated):
        sink.merge_batches(spark, feed.root)
    monkeypatch.undo()
    assert feed.ids() == [1, 2]


def test_many_batches_end_as_few_files(spark, feed):
    feed.write([100_000])
    for step in range(4):
        feed.copy(range(step * 250, (step + 1) * 250))
        assert merges.merge_table(spark, feed.root, TABLE, frozenset(), rows_per_file=400) == 250
    held = merges.current(spark, feed.root, TABLE)
    assert sum(held.rows.values()) == 1000 and len(held.all_batches()) == 1000
    found = sink.read_table(spark, feed.root, TABLE)
    assert found.count() == 1001 and len(merges.read_runs(spark, feed.root, TABLE, held).inputFiles()) <= 5


def test_tables_are_known(spark, feed):
    merges.prepare(spark, feed.root)
    assert all(merges.current(spark, feed.root, t).batches == {} for t in STREAM_TABLES)


def test_a_batch_that_is_one_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch, rows):
    """Events of some 2 KB each, so that a few are a large file; both queries read what one run has stored."""
    given, root = f"{tmp_path}/given", f"{tmp_path}/stream"
    events = spark.range(16_000).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_seconds(1705312800 + id % 7200)").alias("ts"),
        (F.col("id") % 50).alias("user_id"),
        F.expr("element_at(array('purchase', 'view', 'click', 'error', 'signup'), cast(id % 5 + 1 as int))").alias("event_type"),
        (F.col("id") % 90).cast("double").alias("value"),
        F.expr("array_join(transform(sequence(1, 32), i -> sha2(concat(id, '-', i), 256)), '')").alias("pad"),
    )
    props = F.format_string('{"k": %d, "pad": "%s"}', F.col("event_id") % 100, "pad")
    events.withColumn("props", props).drop("pad").write.parquet(f"{given}/events.parquet")
    monkeypatch.setattr(catalog, "stream_root", lambda spark: root)
    queries, quality = catalog.entries(), "mart_rt_data_quality_last_60m"
    assert rows(queries["compacted_rt_transactions"].run(spark, given)) == rows(queries["rt_transactions"].run(spark, given))
    merged = catalog.plain(catalog._merged_quality(spark, f"{root}/tables"), catalog.COLUMNS[quality])
    assert rows(merged) == rows(queries[quality].run(spark, given))
    files = spark.read.parquet(f"{root}/events").inputFiles()
    assert len(files) == 6
    with with_settings(spark, {"spark.sql.files.maxPartitionBytes": "4m"}):
        for file in files:
            assert spark.read.parquet(file).groupBy(F.spark_partition_id()).count().count() > 1
