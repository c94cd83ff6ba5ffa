"""Collapse identical rows to one row with a count, and bring them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

COPIES_PER_TASK = 1_000_000


def restore_copies(df: DataFrame, count: str, copy: str, per_task: int = COPIES_PER_TASK) -> DataFrame:
    """One row per copy, numbered from 1 in ``copy``.

    A large group is cut into chunks that are spread over tasks before the rows
    are produced, so that no task writes more than ``per_task`` copies of a row.
    """
    whole_chunks = F.floor((F.col(count) - 1) / per_task)
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), whole_chunks)))
    first = F.col("_chunk") * per_task + 1
    last = F.least(F.col(count), (F.col("_chunk") + 1) * per_task)
    spread = chunks.repartition(*[F.col(c) for c in df.columns], F.col("_chunk"))
    return spread.withColumn(copy, F.explode(F.sequence(first, last))).drop("_chunk")
