"""Small stream batches merged into a few files, while the stream goes on and readers read.

A merge writes the rows of many batches, each with the batch it came in, to ``merged/<table>/run=<run>``; a manifest
then names the runs that count and the batches each one holds. It is numbered, and the greatest number holds:
a reader takes the runs it names, and of the batch folders those that it does not name. Until it is written nobody
sees the new run. Files it made superfluous stay until the next merge, so that a reader that has begun can end.

Which runs a merge takes in follows from their sizes: a run is rewritten only together with at least half as many
rows again. So sizes grow by a constant factor, there are as many runs as the logarithm of the rows, and a row is
rewritten as many times at most.

The last batch of each query is left alone, as a restart may write it anew. A merge and a clear of the same
tables may run beside each other; a merge that finds the manifest changed gives up, and nothing has happened.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerline.sources.schemas import STREAM_TABLES

ROWS_PER_FILE = 1_000_000
#: A row per run and batch; one row without them, so that a manifest of nothing has a row too.
MANIFEST = StructType([StructField("run", StringType()), StructField("batch_id", StringType()), StructField("rows", LongType())])
#: The folder that gives a table its schema before anything is merged.
NONE = "none"


class Outdated(RuntimeError):
    """The manifest changed while a merge was at work."""


@dataclass(frozen=True)
class Merged:
    """What a manifest names: the batches and the rows of each run."""

    number: int
    batches: dict[str, frozenset[str]]
    rows: dict[str, int]

    def all_batches(self) -> frozenset[str]:
        return frozenset().union(*self.batches.values())


def stored_schema(table: str) -> StructType:
    """The columns of a table and the batch that a row came in."""
    return StructType([*STREAM_TABLES[table][0].fields]).add("batch_id", StringType())


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _path(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    where, fs = _path(spark, path)
    fs.delete(where, True)


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows the prefix in the names of the folders below a path."""
    where, fs = _path(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]


def prepare(spark: SparkSession, root: str) -> None:
    """A first manifest of nothing, and an empty file that gives merged runs a schema."""
    for table in STREAM_TABLES:
        path = f"{root}/merged/{table}/run={NONE}"
        if not exists(spark, path):
            spark.createDataFrame([], stored_schema(table)).coalesce(1).write.mode("overwrite").parquet(path)
        if not exists(spark, f"{root}/merges/{table}"):
            _publish(spark, root, table, Merged(0, {}, {}))


def current(spark: SparkSession, root: str, table: str) -> Merged:
    """The manifest that holds now."""
    path = f"{root}/merges/{table}"
    numbers = [int(n) for n in folders(spark, path, "number=") if exists(spark, f"{path}/number={n}/_SUCCESS")]
    if not numbers:
        return Merged(0, {}, {})
    number, batches, rows = max(numbers), {}, {}
    for row in spark.read.schema(MANIFEST).parquet(f"{path}/number={number}").where("run IS NOT NULL").collect():
        batches.setdefault(row["run"], set()).add(row["batch_id"])
        rows[row["run"]] = row["rows"]
    return Merged(number, {run: frozenset(held) for run, held in batches.items()}, rows)


def _publish(spark: SparkSession, root: str, table: str, merged: Merged) -> None:
    """Write a manifest; an error when its number is taken. The two before it are kept."""
    lines = [(run, batch, merged.rows[run]) for run, held in merged.batches.items() for batch in sorted(held)]
    path = f"{root}/merges/{table}"
    spark.createDataFrame([(None, None, None), *lines], MANIFEST).coalesce(1).write.parquet(f"{path}/number={merged.number}")
    for number in folders(spark, path, "number="):
        if int(number) < merged.number - 2:
            delete(spark, f"{path}/number={number}")


def read_runs(spark: SparkSession, root: str, table: str, merged: Merged) -> DataFrame | None:
    """The rows of the runs; None when there are none."""
    paths = [f"{root}/merged/{table}/run={run}" for run in sorted(merged.batches)]
    return spark.read.schema(stored_schema(table)).parquet(*paths) if paths else None


def drop_cleared(spark: SparkSession, root: str, table: str, cleared: frozenset[str]) -> frozenset[str]:
    """Take out the runs whose batches are all cleared; the cleared batches that other runs still hold."""
    merged = current(spark, root, table)
    whole = {run for run, held in merged.batches.items() if held <= cleared}
    left = {run: held for run, held in merged.batches.items() if run not in whole}
    # written even without a change, so that a merge under way that has read cleared batches gives up
    _publish(spark, root, table, Merged(merged.number + 1, left, {run: merged.rows[run] for run in left}))
    for run in whole:
        delete(spark, f"{root}/merged/{table}/run={run}")
    return cleared & frozenset().union(*left.values())


def _not_last(names: list[str]) -> list[str]:
    """Batches that a later one of the same query follows."""
    last: dict[str, int] = {}
    parts = [(name.rpartition("-")[0], int(name.rpartition("-")[2])) for name in names]
    for query, number in parts:
        last[query] = max(number, last.get(query, -1))
    return [name for name, (query, number) in zip(names, parts, strict=True) if number < last[query]]


def merge_table(spark: SparkSession, root: str, table: str, cleared: frozenset[str], rows_per_file: int = ROWS_PER_FILE) -> int:
    """Merge the loose batches of a table, and runs that are small beside them; how many batches left their folders.

    ``cleared`` batches are left out, and rows of theirs in a run that is rewritten go. Rows are laid out by arrival, so
    that the rolling views skip files.
    """
    prepare(spark, root)
    before = current(spark, root, table)
    folder, held = f"{root}/{table}", before.all_batches()
    # what the merge before this one, or one that failed, has left
    names = folders(spark, folder, "batch_id=")
    for name in held.intersection(names):
        delete(spark, f"{folder}/batch_id={name}")
    for run in set(folders(spark, f"{root}/merged/{table}", "run=")) - {NONE, *before.batches}:
        delete(spark, f"{root}/merged/{table}/run={run}")

    loose = [n for n in _not_last(sorted(set(names) - held - {NONE})) if n not in cleared]
    if not loose:
        return 0
    kind = stored_schema(table)
    fresh = spark.read.option("basePath", folder).schema(kind).parquet(*[f"{folder}/batch_id={n}" for n in loose])
    total, taken = fresh.count(), []
    for run in sorted(before.batches, key=before.rows.get):
        if before.rows[run] > 2 * total:
            break
        taken.append(run)
        total += before.rows[run]

    older = read_runs(spark, root, table, Merged(0, {run: before.batches[run] for run in taken}, {}))
    rows = fresh.select(*kind.names)
    if older is not None:
        gone = sorted(cleared & held)
        rows = rows.union((older.where(~F.col("batch_id").isin(gone)) if gone else older).select(*kind.names))
    run = f"r{uuid.uuid4().hex}"
    order = ["loaded_at", *STREAM_TABLES[table][1]]
    files = -(-total // rows_per_file) or 1
    path = f"{root}/merged/{table}/run={run}"
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(path)

    batches = {r: b for r, b in before.batches.items() if r not in taken}
    batches[run] = frozenset(loose).union(*(before.batches[r] for r in taken)) - cleared
    counts = {r: before.rows[r] for r in batches if r != run} | {run: spark.read.schema(kind).parquet(path).count()}
    if current(spark, root, table).number != before.number:
        raise Outdated(f"{table}: the manifest changed during a merge")
    _publish(spark, root, table, Merged(before.number + 1, batches, counts))
    return len(loose)
