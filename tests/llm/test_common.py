from __future__ import annotations

import random

from ledgerline.llm.common import components, remainder, remainder_of
from pyspark.sql import functions as F


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(500, 500), (7, 7)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + edges[:5]
    rng.shuffle(edges)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_remainder_on_both_sides(spark):
    ids = [0, 17, -4, 2**40, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select(remainder(F.col("doc_id"), 5).alias("r")).collect()
    assert [r.r for r in rows] == [remainder_of(i, 5) for i in ids]
