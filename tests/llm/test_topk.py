from __future__ import annotations

import math
import random

import pytest
from ledgerline.llm import topk
from pyspark.sql import functions as F


def brute(rows, k):
    good = [
        (i, [math.floor(1024 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = {}
    for q, u in good:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(u, v)), i) for i, v in good if i != q)
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, score int")


@pytest.mark.parametrize("count", [0, 3, 700])
def test_equals_brute_force(spark, monkeypatch, count):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", 4)
    rng = random.Random(count)
    rows = [(i, [rng.choice([-0.5, 0.25, rng.uniform(-1, 1)]) for _ in range(8)]) for i in range(count)]
    if count > 3:
        rows += [(i, rows[5][1]) for i in range(1000, 1040)]  # ties
        rows += [(2000, None), (2001, [1.0, None]), (2100, [float("nan")]), (2101, [float("inf")]), (None, [1.0]), (2200, [1.0, -2.0]), (2201, [])]
    got = topk.top_k(table(spark, rows), F.col("vec_id") % 100 == 0, 10)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert found == {q: v for q, v in brute(rows, 10).items() if v}


def test_rows_that_repeat_a_query_id_are_one_query_of_the_least_vector(spark):
    rows = [(100, [0.5, 1.0]), (100, [0.5, -1.0]), (100, [0.5, 3.0]), (1, [1.0, 2.0]), (2, [2.0, -1.0]), (2, [4.0, 0.0])]
    for _ in range(2):
        got = topk.top_k(table(spark, rows).repartition(4), F.col("vec_id") % 100 == 0, 10)
        found = sorted((r["rank"], r.vec_id, r.score) for r in got.collect())
        one = 1024 * 1024
        assert found == [(1, 2, 2 * one), (2, 2, 2 * one), (3, 1, one // 2 - 2 * one)]
        rows.reverse()
