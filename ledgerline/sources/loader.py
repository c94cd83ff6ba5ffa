"""Incremental load of JSON-lines files into raw tables, with a load log.

A run lists the files of each feed, drops those the log holds a success for,
and loads the rest in bounded batches. A batch writes its rows once, under
``raw/<table>/load_id=<id>``; the log rows come last and are the commit: readers
take only load ids the log names. A crash in between leaves rows nobody reads,
and the next run loads the files again under a new id.

Two tiers of bad input: a line that is not JSON is put aside and its file still
succeeds; a file with a value of the wrong type, or one that cannot be read,
fails as a whole and stays out, and costs no other file its load.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ledgerline.session import configure, fits_broadcast, settle
from ledgerline.sources.files import list_files, new_files, parse_lines, read_lines, typed
from ledgerline.sources.schemas import FEEDS, LOAD_LOG, REJECTS, Feed, raw_schema


# Batches of a feed that are loaded at a time.
SIDE_BY_SIDE = 4


@dataclass(frozen=True)
class LoadResult:
    source_type: str
    table: str
    files: int
    failed_files: int


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(microsecond=0)


class RawStore:
    """Raw tables, rejects and load log under one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self._log_lock = Lock()

    def _stored(self, name: str, schema: StructType) -> DataFrame:
        path = f"{self.root}/{name}"
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def load_log(self) -> DataFrame:
        return self._stored("load_log", LOAD_LOG)

    def commits(self) -> DataFrame:
        """Load ids the log holds a success for: one per load job, stored apart so that its size is known."""
        return settle(self.load_log().where("status = 'success'").select("load_id").distinct(), "commits")

    def _committed(self, rows: DataFrame, commits: DataFrame | None) -> DataFrame:
        """Keep committed loads; with the ids broadcast, the rows are not shuffled for it."""
        ids = self.commits() if commits is None else commits
        return rows.join(F.broadcast(ids) if fits_broadcast(ids) else ids, "load_id", "left_semi").drop("load_id")

    def rejects(self) -> DataFrame:
        return self._committed(self._stored("rejects", REJECTS), None)

    def table(self, feed: Feed, commits: DataFrame | None = None) -> DataFrame:
        """Committed rows of a raw table, as of ``commits`` when given."""
        schema = raw_schema(feed).add("load_id", StringType())
        return self._committed(self._stored(f"raw/{feed.table}", schema), commits)

    def pending(self, source_root: str, feed: Feed) -> DataFrame:
        return new_files(list_files(self.spark, source_root, feed), self.load_log())

    def load(
        self, source_root: str, feed: Feed, files_per_batch: int | None = None, side_by_side: int = SIDE_BY_SIDE
    ) -> LoadResult:
        """Load the new files of one feed, several batches at a time.

        A batch that fails is halved until the file that fails it stands alone;
        that file is logged as failed, everything else is loaded, and the first
        error is raised at the end.
        """
        pending = self.pending(source_root, feed).persist()
        try:
            total = pending.count()
            batches = -(-total // (files_per_batch or feed.files_per_batch))

            def one(number: int) -> tuple[int, list[Exception]]:
                # A hash split keeps the batches even without ordering the listing.
                part = pending.where(F.pmod(F.xxhash64("source_file"), F.lit(batches)) == number)
                # One batch of file names: bounded by the batch size, not by the data.
                return self._load_batch(source_root, feed, part, sorted(r.source_file for r in part.select("source_file").collect()))

            with ThreadPoolExecutor(side_by_side) as pool:
                done = list(pool.map(one, range(batches)))
        finally:
            pending.unpersist()
        errors = [e for _, found in done for e in found]
        if errors:
            raise errors[0]
        return LoadResult(feed.source_type, feed.table, total, sum(failed for failed, _ in done))

    def load_all(self, source_root: str, feeds: list[Feed] | None = None, **options) -> list[LoadResult]:
        return [self.load(source_root, feed, **options) for feed in feeds or FEEDS]

    def _load_batch(
        self, source_root: str, feed: Feed, part: DataFrame, names: list[str]
    ) -> tuple[int, list[Exception]]:
        """How many files had mistyped rows, and the errors of files that could not be loaded at all."""
        if not names:
            return 0, []
        load_id, started = uuid.uuid4().hex, _now()
        files = part.where(F.col("source_file").isin(names))
        try:
            mistyped = self._write_rows(source_root, feed, names, load_id)
            return self._write_log(feed, files, load_id, started, mistyped), []
        except Exception as error:
            if len(names) > 1:
                halves = [names[: len(names) // 2], names[len(names) // 2 :]]
                done = [self._load_batch(source_root, feed, part, half) for half in halves]
                return sum(n for n, _ in done), [e for _, found in done for e in found]
            entry = files.select(
                F.lit(feed.source_type).alias("source_type"),
                "source_file",
                "file_size",
                F.lit(0).cast("bigint").alias("loaded_rows"),
                F.lit("failed").alias("status"),
                F.lit(str(error)).alias("error_message"),
            )
            self._append_log(entry, started, load_id)
            return 0, [error]

    def _raw_path(self, feed: Feed, load_id: str) -> str:
        return f"{self.root}/raw/{feed.table}/load_id={load_id}"

    def _write_rows(self, source_root: str, feed: Feed, names: list[str], load_id: str) -> DataFrame | None:
        """Write rows and rejects; return the files with mistyped rows, if there are any."""
        lines = read_lines(self.spark, source_root, names)
        parsed = typed(parse_lines(lines, feed), feed)
        seen = Observation()
        watched = parsed.observe(
            seen,
            F.coalesce(F.sum(F.col("mistyped").cast("int")), F.lit(0)).alias("mistyped"),
            F.coalesce(F.sum(F.col("broken").cast("int")), F.lit(0)).alias("broken"),
        )
        self._write_good(watched, feed, load_id)
        counts = seen.get
        if counts["broken"]:
            rejects = parsed.where("broken").select(F.lit(feed.source_type).alias("source_type"), "source_file", "line")
            rejects.write.parquet(f"{self.root}/rejects/load_id={load_id}")
        if not counts["mistyped"]:
            return None
        # Rare: name the bad files and write the batch again without them.
        bad = parsed.where("mistyped AND NOT broken").select("source_file").distinct()
        self._write_good(parsed.join(bad, "source_file", "left_anti"), feed, load_id)
        return bad

    def _write_good(self, parsed: DataFrame, feed: Feed, load_id: str) -> None:
        rows = parsed.where("NOT broken").select(
            *feed.fields, "source_file", F.current_timestamp().alias("loaded_at")
        )
        rows.sortWithinPartitions(*feed.sort_key).write.mode("overwrite").parquet(self._raw_path(feed, load_id))

    def _write_log(
        self, feed: Feed, part: DataFrame, load_id: str, started: datetime, mistyped: DataFrame | None
    ) -> int:
        """Log every file of the batch; return how many failed."""
        rows = self.spark.read.schema(raw_schema(feed)).parquet(self._raw_path(feed, load_id))
        loaded = rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
        entries = part.join(loaded, "source_file", "left").withColumn("wrong", F.lit(False))
        if mistyped is not None:
            wrong = mistyped.withColumn("wrong", F.lit(True))
            entries = entries.drop("wrong").join(wrong, "source_file", "left").fillna(False, ["wrong"])
        entries = entries.select(
            F.lit(feed.source_type).alias("source_type"),
            "source_file",
            "file_size",
            F.coalesce("n", F.lit(0)).cast("bigint").alias("loaded_rows"),
            F.when(F.col("wrong"), "failed").otherwise("success").alias("status"),
            F.when(F.col("wrong"), "value of the wrong type").otherwise("").alias("error_message"),
        )
        self._append_log(entries, started, load_id)
        return 0 if mistyped is None else mistyped.count()

    def _append_log(self, entries: DataFrame, started: datetime, load_id: str) -> None:
        stamped = entries.withColumns(
            {
                "started_at": F.lit(started).cast("timestamp"),
                "finished_at": F.lit(_now()).cast("timestamp"),
                "load_id": F.lit(load_id),
            }
        )
        ordered = stamped.select(*LOAD_LOG.names).sortWithinPartitions("source_type", "source_file", "started_at")
        with self._log_lock:  # two appends to one folder at a time would clear away each other's files
            ordered.write.mode("append").parquet(f"{self.root}/load_log")
