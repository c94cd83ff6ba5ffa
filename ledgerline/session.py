"""Session settings, the shared scratch folder and the one broadcast rule."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# A side is broadcast on request only after its rows and its stored bytes were held against these.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Shuffle sizing: input bytes per partition. There is no upper bound unless a site sets one.
BYTES_PER_PARTITION = 64 * 1024 * 1024
MOST_PARTITIONS: int | None = None
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method of more than 8000 bytes; a stage with a larger one runs as single operators instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_BLOOM = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}
# Shuffle files of a settled result are deleted as soon as it is written.
_CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_local_scratch: dict[str, str] = {}
_settled: dict[str, list[str]] = {}
_declared: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan here relies on."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "ledgerline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """The folder shared by all executors, as the cluster names it.

    Only a local session may go without one; it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_scratch:
        folder = tempfile.mkdtemp(prefix="ledgerline-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_scratch[context.applicationId] = folder
    return _local_scratch[context.applicationId]


def stored_bytes(df: DataFrame) -> int | None:
    """Bytes of the files below ``df``, as its scans have listed them; None when a part is not read from files."""
    leaves, total = df._jdf.queryExecution().optimizedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        relation = leaf.relation() if leaf.getClass().getSimpleName() == "LogicalRelation" else None
        if relation is None or not relation.getClass().getName().endswith("HadoopFsRelation"):
            return None
        total += int(str(relation.location().sizeInBytes()))
    return total


def wanted_partitions(df: DataFrame) -> int:
    """Shuffle partitions in step with the files below ``df``; 0 when their size is not known."""
    size = stored_bytes(df)
    wanted = 0 if size is None else -(-size // BYTES_PER_PARTITION)
    return wanted if MOST_PARTITIONS is None else min(MOST_PARTITIONS, wanted)


def size_shuffles(df: DataFrame) -> int:
    """Start shuffles with partitions in step with the files below ``df``.

    Adaptive execution merges partitions that turn out small but cannot split a
    shuffle that was planned too coarse, so the start follows the input size.
    Settings above that are left alone, and so are all when the size is unknown.
    """
    spark = df.sparkSession
    wanted = wanted_partitions(df)
    planned = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(_INITIAL, "1")))
    if wanted > planned:
        spark.conf.set(_INITIAL, str(wanted))
    return max(wanted, planned)


@contextmanager
def with_settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what runs inside; they are as before afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def sized_shuffles(df: DataFrame) -> Iterator[int]:
    """``size_shuffles`` for what runs inside; the setting is as before afterwards."""
    spark = df.sparkSession
    before = spark.conf.get(_INITIAL, None)
    try:
        yield size_shuffles(df)
    finally:
        if before is None:
            spark.conf.unset(_INITIAL)
        else:
            spark.conf.set(_INITIAL, before)


def bloom_joins(spark: SparkSession):
    """Let Spark filter the large side of a join by a Bloom filter of the other's keys, whatever its size.

    It does so for joins that run inside and whose other side is a stored table, marked by ``selective``.
    """
    return with_settings(spark, _BLOOM)


def selective(stored: DataFrame, key: str) -> DataFrame:
    """The rows with a (long) key: a condition that tells Spark that joining with them leaves rows out."""
    return stored.where(F.col(key) >= F.lit(-(2**63)))


def settle(df: DataFrame, label: str, by: str | None = None, unlike: tuple[str, ...] = ()) -> DataFrame:
    """Write an intermediate result to the shared folder, in a folder for each value of ``by`` if given, and read it back.

    This cuts the lineage, survives lost executors, and gives Catalyst the
    true size of the result, so that it can choose a broadcast by itself.
    The folder is kept until ``sweep_settled`` or a ``settling`` block ends it.
    Columns (paths in the file) whose values hardly repeat, ``unlike``, are written without dictionaries.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/settled/{label}-{uuid.uuid4().hex}"
    with sized_shuffles(df), with_settings(spark, _CLEANUP):
        write = df.write.options(**{f"parquet.enable.dictionary#{column}": "false" for column in unlike})
        (write.partitionBy(by) if by else write).parquet(path)
    _settled.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled_at(spark: SparkSession, label: str) -> str:
    """A folder in the shared folder that goes with the settled ones."""
    path = f"{scratch_folder(spark)}/settled/{label}-{uuid.uuid4().hex}"
    _settled.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def declare_settled(path: str, table: str) -> None:
    """A table over a settled folder, to be dropped with it."""
    _declared[path] = table


def sweep_settled(spark: SparkSession, since: int = 0) -> int:
    """Delete the folders this application has settled, from the ``since``-th on; how many there were."""
    paths = _settled.get(spark.sparkContext.applicationId, [])
    gone, paths[since:] = paths[since:], []
    for path in gone:
        if path in _declared:
            spark.sql(f"DROP TABLE IF EXISTS {_declared.pop(path)}")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(gone)


@contextmanager
def settling(spark: SparkSession) -> Iterator[None]:
    """Folders settled inside go when the block ends; nothing lazy that reads them may outlive it."""
    since = len(_settled.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        sweep_settled(spark, since)


def fits_broadcast(settled: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a settled table is small enough to broadcast: its stored bytes, and a footer-only count."""
    size = stored_bytes(settled)
    return (size is None or size <= BROADCAST_BYTES) and settled.count() <= limit
