"""Helpers shared by the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.session import bloom_joins, selective, settle

__all__ = ["arrow_rows", "bloom_joins", "components", "drop_settled", "read_table", "remainder", "selective", "settle"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id's text modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def remainder_of(doc_id: int | None, by: int) -> int:
    """The same for one Python value."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % by


def drop_settled(*frames: DataFrame, kind: str | None = None) -> None:
    """Delete the folders of settled tables that no later frame reads; of tables settled by kind, one kind's if given."""
    for frame in frames:
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            if kind is not None and not folder.endswith(f"/kind={kind}"):
                continue
            jvm = frame.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def arrow_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, root)``, root being the smallest node.

    Alternates large-star and small-star steps: each is one aggregate and one join on the node, so
    no component is ever collected, and the edge count never grows. Every step is written to the
    shared folder, which also cuts the lineage. Stops when a round changes no edge.
    """
    kept = settle(_pairs(edges), "edges")
    state = None
    while True:
        large = settle(_star(kept, larger_only=True), "large")
        small = settle(_star(large, larger_only=False), "small")
        found = small.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_settled(kept, large)
        kept = small
        if tuple(found) == state:
            break
        state = tuple(found)
    roots = kept.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(kept.select("a", "a")).distinct()


def _pairs(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, the smaller node first, no loops."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of each node (the larger ones, or the smaller ones) to its smallest neighbour."""
    if larger_only:
        near = pairs.select(F.col("a").alias("n"), F.col("b").alias("m")).union(pairs.select("b", "a"))
    else:
        near = pairs.select(F.col("b").alias("n"), F.col("a").alias("m"))
    least = settle(near.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low")), "least")
    linked = near.join(least, "n")
    if larger_only:
        out = linked.where("m > n").select(F.col("low").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("low").alias("a"), F.col("m").alias("b")).union(least.select("low", "n"))
    return _pairs(out)
