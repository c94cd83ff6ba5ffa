from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "ledgerline-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write_lines():
    """Write a JSON-lines file; strings go in as they are."""

    def write(path, rows):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as out:
            for row in rows:
                out.write((row if isinstance(row, str) else json.dumps(row)) + "\n")

    return write


def as_tuples(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.fixture
def rows():
    return as_tuples
