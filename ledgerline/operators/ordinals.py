"""row_number() for groups too large for one task.

A plain window sorts a whole group in one task. Here identical rows are first
collapsed, the rest is cut into cells (group, time, salt), and the start of
each cell comes from running sums over cell counts. Those sums run per
(group, day), and per group over its days, so each window is bounded by the
seconds of a day or the days of the data whatever the size of the group.
Rows that tie on time are ordered by their content hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.operators.copies import restore_copies

EARLIEST = "0001-01-01 00:00:00"


def number_rows(df: DataFrame, group: str, at: str, out: str, salts: int = 64) -> DataFrame:
    """Add ``out``: the position of a row in its group by ``at``, NULL times first."""
    columns = df.columns
    moment = F.coalesce(F.date_trunc("second", at), F.lit(EARLIEST).cast("timestamp"))
    rows = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_at", moment)
        .withColumn("_day", F.to_date("_at"))
        .withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(salts)))
    )
    cell = [group, "_day", "_at", "_salt"]
    cells = rows.groupBy(*cell).agg(F.sum("_copies").alias("_n"))
    days = cells.groupBy(group, "_day").agg(F.sum("_n").alias("_n"))

    before = (Window.unboundedPreceding, -1)
    per_group = Window.partitionBy(group).orderBy("_day").rowsBetween(*before)
    per_day = Window.partitionBy(group, "_day").orderBy("_at", "_salt").rowsBetween(*before)
    per_cell = Window.partitionBy(*cell).orderBy(at, *columns).rowsBetween(*before)

    def running(window):
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    day_starts = days.select(group, "_day", running(per_group).alias("_day_start"))
    starts = (
        cells.withColumn("_cell_start", running(per_day))
        .join(day_starts, [group, "_day"])
        .select(*cell, (F.col("_day_start") + F.col("_cell_start")).alias("_start"))
    )
    numbered = rows.join(starts, cell).withColumn(
        "_start", F.col("_start") + F.coalesce(F.sum("_copies").over(per_cell), F.lit(0))
    )
    restored = restore_copies(numbered, "_copies", "_copy")
    return restored.select(*columns, (F.col("_start") + F.col("_copy")).alias(out))
