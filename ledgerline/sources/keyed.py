"""Raw transactions with their keys, stored by file day and key bucket.

A natural key names the day of its file, so rows that collide are rows of one file day. They are stored with key, time
and types worked out, in a table that is partitioned by (file day, run) and bucketed by the key: the paths are parsed
once, and counting keys of any days needs no shuffle, as a bucket's rows of a key are read by one task. Rows of a
repeated run replace those of the same run.

The table lives in its folder; a session that does not know it declares it there again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.keys import DAY_PART, path_part
from ledgerline.plans.staging import keyed_transactions
from ledgerline.session import sized_shuffles, with_settings
from ledgerline.sources.daytables import NO_DAY, day_text
from ledgerline.sources.schemas import TRANSACTIONS, raw_schema

BUCKETS = 8


class KeyedRows:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, f"{root.rstrip('/')}/keyed", buckets
        self.table = f"keyed_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"

    def declare(self, schema: StructType) -> None:
        """Make the table known to the session, with the days that are in its folder."""
        if self.spark.catalog.tableExists(self.table):
            return
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(where)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in ("file_day", "run"))
        self.spark.sql(
            f"CREATE TABLE {self.table} ({columns}, file_day STRING, run STRING) USING parquet PARTITIONED BY (file_day, run) "
            f"CLUSTERED BY (transaction_nk) SORTED BY (transaction_nk) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        self.spark.catalog.recoverPartitions(self.table)

    @staticmethod
    def keyed(raw: DataFrame, run: str) -> DataFrame:
        day = path_part(F.col("source_file"), DAY_PART)
        return keyed_transactions(raw).withColumns(
            {
                "created_day": day_text(F.col("created_at")),
                "file_day": F.when(day == "", NO_DAY).otherwise(day),
                "run": F.lit(run),
            }
        )

    def insert(self, raw: DataFrame, run: str) -> set[str]:
        """Store new raw rows in one scan; the file days they are of."""
        rows = self.keyed(raw, run)
        self.declare(rows.schema)
        bucket = F.pmod(F.hash("transaction_nk"), F.lit(self.buckets))
        with sized_shuffles(raw), with_settings(self.spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            placed = rows.withColumn("_bucket", bucket).hint("rebalance", "file_day", "_bucket").drop("_bucket")
            placed.write.insertInto(self.table, overwrite=True)
        found = self.spark.sql(f"SHOW PARTITIONS {self.table} PARTITION (run = '{run}')").collect()
        return {r.partition.split("/")[0].removeprefix("file_day=") for r in found}

    def rows(self, runs: dict[str, tuple[str, ...]], days: Iterable[str]) -> DataFrame:
        """The rows of file days, of the runs that the manifest has for them."""
        self.declare(self.keyed(self.spark.createDataFrame([], raw_schema(TRANSACTIONS)), "").schema)
        days = sorted(runs.keys() & set(days))
        named = sorted({run for day in days for run in runs[day]})
        if not days:
            return self.spark.table(self.table).where("false")
        return self.spark.table(self.table).where(F.col("file_day").isin(days) & F.col("run").isin(named))
