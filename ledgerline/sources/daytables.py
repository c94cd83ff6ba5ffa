"""Tables kept by day, where a run replaces single days and everything becomes visible at once.

A run writes what it rebuilds under ``tables/<name>/run=<run>/day=<day>``. A manifest names, for each table and day, the
runs whose files make it up: one for a day that was built as a whole, several for rows that arrived in parts. A run
ends by writing the next manifest; until then nobody sees its files, afterwards nobody sees the files it replaced,
and readers that hold an older manifest go on with the old ones. So a failed run costs nothing and can be repeated.

A manifest has a row per table, day and run, which is all that passes through the driver. One run is made at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.session import configure

#: The day of rows whose day is not known, and of tables that are not kept by day.
NO_DAY = "none"
WHOLE = "all"
MANIFEST = StructType([StructField(c, StringType()) for c in ("name", "day", "run", "schema")])
#: Manifests that are kept, with the files only they name.
KEPT_MANIFESTS = 3

Runs = dict[str, dict[str, tuple[str, ...]]]


def day_text(day):
    """The ``day`` column of a date or time."""
    return F.coalesce(F.to_date(day).cast("string"), F.lit(NO_DAY))


class Snapshot:
    """The tables as one manifest has them."""

    def __init__(self, tables: DayTables, runs: Runs, schemas: dict[str, str]):
        self.tables, self.runs, self.schemas = tables, runs, schemas

    def days(self, name: str) -> set[str]:
        return set(self.runs.get(name, {}))

    def has(self, name: str) -> bool:
        return name in self.schemas

    def read(self, name: str, days: Iterable[str] | None = None) -> DataFrame:
        """All rows, or those of the given days alone: other days' files are not even listed."""
        schema = StructType.fromJson(json.loads(self.schemas[name])).add("run", StringType()).add("day", StringType())
        held = self.runs.get(name, {})
        wanted = held if days is None else held.keys() & set(days)
        base = f"{self.tables.root}/tables/{name}"
        paths = [f"{base}/run={run}/day={day}" for day in sorted(wanted) for run in held[day]]
        spark = self.tables.spark
        if not paths:
            return spark.createDataFrame([], schema).drop("run")
        return spark.read.schema(schema).option("basePath", base).parquet(*paths).drop("run")


class Run(Snapshot):
    """A snapshot that a run is changing: it reads what it has written itself."""

    def __init__(self, tables: DayTables, before: Snapshot):
        super().__init__(tables, {n: dict(d) for n, d in before.runs.items()}, dict(before.schemas))
        self.before = before
        self.id = uuid.uuid4().hex
        self.written: dict[str, set[str]] = {}

    def _write(self, name: str, rows: DataFrame) -> set[str]:
        path = f"{self.tables.root}/tables/{name}/run={self.id}"
        rows.hint("rebalance", "day").write.partitionBy("day").mode("overwrite").parquet(path)
        self.schemas[name] = json.dumps(rows.drop("day").schema.jsonValue())
        days = set(self.tables.folders(path, "day="))
        self.written[name] = self.written.get(name, set()) | days
        return days

    def append(self, name: str, rows: DataFrame) -> set[str]:
        """Add rows to their days; the days that got some."""
        days = self._write(name, rows)
        for day in days:
            held = self.runs.setdefault(name, {})
            held[day] = (*held.get(day, ()), self.id)
        return days

    def replace(self, name: str, rows: DataFrame, days: Iterable[str]) -> None:
        """Make ``rows`` all there is of the given days; a day without rows is gone."""
        found, held = self._write(name, rows), self.runs.setdefault(name, {})
        if not found <= set(days):
            raise ValueError(f"{name}: rows of other days: {sorted(found - set(days))}")
        for day in days:
            held.pop(day, None)
        held.update(dict.fromkeys(found, (self.id,)))

    def put(self, name: str, rows: DataFrame) -> None:
        """Replace a table that is not kept by day."""
        self.replace(name, rows.withColumn("day", F.lit(WHOLE)), [WHOLE])

    def publish(self) -> None:
        rows = [(n, d, r, None) for n, held in self.runs.items() for d, runs in held.items() for r in runs]
        rows += [(n, None, None, s) for n, s in self.schemas.items()]
        number = max(self.tables.manifests(), default=0) + 1
        path = f"{self.tables.root}/manifests/number={number}"
        self.tables.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(path)
        self.tables.retire()


class DayTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = configure(spark), root.rstrip("/")

    def _path(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def folders(self, path: str, prefix: str) -> list[str]:
        """What follows the prefix in the names of the folders below a path."""
        where, fs = self._path(path)
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
        return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]

    def manifests(self) -> list[int]:
        """Numbers of the manifests that were written to their end."""
        found = []
        for number in self.folders(f"{self.root}/manifests", "number="):
            where, fs = self._path(f"{self.root}/manifests/number={number}/_SUCCESS")
            if fs.exists(where):
                found.append(int(number))
        return sorted(found)

    def snapshot(self, number: int | None = None) -> Snapshot:
        numbers = self.manifests()
        if not numbers:
            return Snapshot(self, {}, {})
        runs: Runs = {}
        schemas: dict[str, str] = {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/number={number or numbers[-1]}").collect()
        for row in sorted(rows, key=lambda r: (r.name, r.day or "", r.run or "")):
            if row.schema:
                schemas[row.name] = row.schema
            else:
                held = runs.setdefault(row.name, {})
                held[row.day] = (*held.get(row.day, ()), row.run)
        return Snapshot(self, runs, schemas)

    def begin(self) -> Run:
        return Run(self, self.snapshot())

    def retire(self, kept: int = KEPT_MANIFESTS) -> int:
        """Delete manifests but the last ones, and files that none of those names; how many days' files went."""
        numbers = self.manifests()
        old, live = numbers[:-kept], set()
        if not old:
            return 0
        for number in numbers[-kept:]:
            for name, held in self.snapshot(number).runs.items():
                live |= {(name, day, run) for day, runs in held.items() for run in runs}
        gone = 0
        for number in old:
            for name, held in self.snapshot(number).runs.items():
                for day, runs in held.items():
                    for run in runs:
                        if (name, day, run) not in live:
                            where, fs = self._path(f"{self.root}/tables/{name}/run={run}/day={day}")
                            gone += bool(fs.delete(where, True))
            where, fs = self._path(f"{self.root}/manifests/number={number}")
            fs.delete(where, True)
        return gone
