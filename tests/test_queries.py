"""Every registered query against its SQL twin on the smallest given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        return value if value is None or isinstance(value, str) else round(float(value), 8)

    cut = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(cut, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_twin(spark, sql, name):
    frame = contract.queries()[name](spark, SF_DIR)
    twin = sql.execute(contract.oracle_sql()[name])
    names = [d[0] for d in twin.description]
    assert comparable(frame.columns, [tuple(r) for r in frame.collect()]) == comparable(names, twin.fetchall())


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
