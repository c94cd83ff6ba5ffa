"""The latest row per key as stream state, so that a read collapses nothing.

A streaming aggregate keeps one row for each key and replaces it when a later one arrives; what a table holds is what its
state holds, read back from the checkpoint. Rows that arrive again or late change nothing, and a restarted query goes
on with the state of its last batch. With a time to live, keys that got no row for so long leave the state; as an
aggregate has none, a Python processor keeps the rows then, at some half a millisecond a key. Either form goes on with
a checkpoint of its own form only.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.operators.latest import latest_per_key
from ledgerline.session import with_settings
from ledgerline.sources.schemas import STREAM_TABLES
from ledgerline.streaming.feeds import FEEDS, observed, parse_messages

_STATE = "latest"
_AGGREGATE = "stateStoreSave"  # as Spark names the operator of an aggregate in a checkpoint
_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _rank(row: tuple, order: list[int]) -> list[tuple]:
    """Rows compare by their values in this order, a missing value being the smallest."""
    return [(row[i] is not None, row[i]) for i in order]


class KeepLatest(StatefulProcessor):
    """Keeps the row with the greatest ``by`` of a key, ties going to the greater row; gives it whenever it changes."""

    def __init__(self, schema: StructType, by: str, ttl_ms: int | None = None):
        rest = [i for i, name in enumerate(schema.names) if name != by]
        self.schema, self.order, self.ttl_ms = schema, [schema.names.index(by), *rest], ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState(_STATE, self.schema, self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.held.get()
        best = tuple(before) if before is not None else None
        for row in rows:
            found = tuple(row[name] for name in self.schema.names)
            if best is None or _rank(found, self.order) > _rank(best, self.order):
                best = found
        if best is not None and (before is None or best != tuple(before)):
            self.held.update(best)
            yield Row(**dict(zip(self.schema.names, best, strict=True)))

    def close(self) -> None:
        pass


def _times(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if f.dataType.typeName() == "timestamp"]


def latest_rows(rows: DataFrame, key: list[str], by: str, ttl_ms: int | None = None) -> DataFrame:
    """A stream of the latest row per key, each time it changes; without a time to live, also when an earlier row of the key comes.

    With a time to live, times are kept as microseconds, which mean the same in every worker, whatever its zone.
    """
    if ttl_ms is None:
        return latest_per_key(rows, key, by)
    times = _times(rows.schema)
    plain = rows.withColumns({c: F.unix_micros(c) for c in times})
    kept = plain.groupBy(*key).transformWithState(KeepLatest(plain.schema, by, ttl_ms), plain.schema, "Update", "ProcessingTime")
    return kept.withColumns({c: F.timestamp_micros(c) for c in times})


def keep_feed(
    messages: DataFrame, table: str, checkpoint: str, arrival: str | None = None, once: bool = False, ttl_ms: int | None = None, interval: str = "2 seconds"
) -> StreamingQuery:
    """Keep a stream table as state below ``checkpoint``; over what is there now with ``once``, else until stopped.

    A time to live needs batches as long as time goes on, so such a query has no end of its own.
    """
    if once and ttl_ms:
        raise ValueError("a query with a time to live runs until it is stopped")
    spark, (schema, key) = messages.sparkSession, STREAM_TABLES[table]
    rows = FEEDS[table](observed(parse_messages(messages, arrival))).select(*schema.names)
    kept = latest_rows(rows, list(key), "loaded_at", ttl_ms)
    writer = kept.writeStream.outputMode("update").option("checkpointLocation", checkpoint).format("noop")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    with with_settings(spark, _STORE):
        return writer.start()


def kept_rows(spark: SparkSession, checkpoint: str, schema: StructType) -> DataFrame:
    """The rows that the state holds as of its last finished batch: one for each key, nothing to collapse."""
    operators = {r.operatorName for r in spark.read.format("state-metadata").load(checkpoint).select("operatorName").distinct().collect()}
    with with_settings(spark, _STORE):
        if operators == {_AGGREGATE}:
            state = spark.read.format("statestore").load(checkpoint)
            keys, held = state.schema["key"].dataType.names, state.schema["value"].dataType.names[0]  # one buffer: the row without its key
            return state.select(*[F.col(f"key.{c}" if c in keys else f"value.{held}.{c}").alias(c) for c in schema.names])
        state = spark.read.format("statestore").option("stateVarName", _STATE).load(checkpoint)
    value = "value.value" if "ttlExpirationMs" in state.schema["value"].dataType.names else "value"
    rows, times = state.select(f"{value}.*"), _times(schema)
    return rows.select(*[(F.timestamp_micros(c) if c in times else F.col(c)).alias(c) for c in schema.names])


def kept_table(spark: SparkSession, checkpoint: str, table: str) -> DataFrame:
    """A stream table as ``keep_feed`` keeps it."""
    return kept_rows(spark, checkpoint, STREAM_TABLES[table][0])
