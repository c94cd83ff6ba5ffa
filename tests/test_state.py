"""Stream state that keeps the latest row per key."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest

from ledgerline.operators.latest import latest_per_key
from ledgerline.session import with_settings
from ledgerline.streaming import state

SCHEMA = "k string, at timestamp, v int, note string"
START = datetime(2024, 1, 1)


def row(key, minute, value, note=None):
    return (key, START + timedelta(minutes=minute), value, note)


def test_equals_latest_after_replays_late_rows_and_a_restart(spark, rows, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def step(*batch):
        spark.createDataFrame(list(batch), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        kept = state.latest_rows(stream, ["k"], "at")  # each step is a query started anew
        with with_settings(spark, state._STORE):
            query = kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        expected = rows(latest_per_key(spark.read.parquet(source), ["k"], "at"), "k", "at", "v", "note")
        assert rows(state.kept_rows(spark, checkpoint, stream.schema)) == expected

    step(row("a", 5, 1), row("a", 6, 2, "x"), row("b", 1, 3), row(None, 2, 4))
    step(row("a", 6, 2, "x"), row("a", 1, 9), row("b", 1, 3, "tie"), row("b", 1, None), row("c", 0, 7))
    step(row("c", 0, 7), row(None, 3, None))


def test_a_time_to_live(spark, tmp_path):
    """Kept rows are read back whole; a row whose time is over is replaced by an earlier one that arrives."""
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def step(ttl_ms, found):
        spark.createDataFrame([found], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        kept = state.latest_rows(spark.readStream.schema(SCHEMA).parquet(source), ["k"], "at", ttl_ms)
        with with_settings(spark, state._STORE):
            query = kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).start()
        for _ in range(240):
            if query.exception() or any(p["numInputRows"] for p in query.recentProgress):
                break
            time.sleep(0.25)
        query.stop()
        return [r.v for r in state.kept_rows(spark, checkpoint, spark.read.parquet(source).schema).collect()]

    assert step(1, row("a", 5, 1)) in ([1], [])
    time.sleep(0.1)
    assert step(3_600_000, row("a", 1, 2)) == [2]
    with pytest.raises(ValueError):
        state.keep_feed(spark.readStream.schema("value string").text(source), "rt_transactions", checkpoint, once=True, ttl_ms=1)


def test_rows_without_a_time_to_live_are_kept_without_python(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    spark.createDataFrame([row("a", 5, 1), row("a", 6, 2), row("b", 1, 3)], SCHEMA).write.parquet(source)
    kept = state.latest_rows(spark.readStream.schema(SCHEMA).parquet(source), ["k"], "at")
    with with_settings(spark, state._STORE):
        query = kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r.operatorName for r in spark.read.format("state-metadata").load(checkpoint).collect()] == ["stateStoreSave"]
    assert sorted((r.k, r.v) for r in state.kept_rows(spark, checkpoint, spark.read.parquet(source).schema).collect()) == [("a", 2), ("b", 3)]
