"""The stages on the smallest given tables, each against what it must do to its own input."""

from __future__ import annotations

import os

import __spark_entry__ as contract
import corpus_pipeline
import pytest
from ledgerline.llm import decontaminate as de, queries, stages
from ledgerline.llm.common import read_table, settle

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 11))
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in contract.oracle_sql()


def test_stages(spark):
    first = read_table(spark, SF_DIR, "documents")
    docs, kept = first, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF_DIR), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == first.columns
    texts = {name: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()} for name, df in kept.items() if name != "packing"}
    assert set(texts["line_dedup"]) <= set(texts["language_id"]) and set(texts["decontamination"]) <= set(texts["near_duplicates"])
    lines = [(" ".join(sorted(set(x.lower().split()))), i) for i, t in sorted(texts["line_dedup"].items()) for x in t.split("\n") if x.strip()]
    assert len({x for x, _ in lines}) == len(lines)
    groups = {}
    from ledgerline.llm.jaccard import join_components

    for r in join_components(kept["line_dedup"]).collect():
        groups.setdefault(r.component_id, []).append(r.doc_id)
    assert set(texts["near_duplicates"]) == set(groups)
    items = [de.normal(r.text) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    clean = {i for i, t in texts["near_duplicates"].items() if not any(x in de.normal(t) for x in items)}
    assert set(texts["decontamination"]) <= clean
    assert {r.doc_id for r in kept["packing"].select("doc_id").collect()} == set(texts["decontamination"])


def test_stages_on_an_empty_table(spark):
    docs = read_table(spark, SF_DIR, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF_DIR), name)
    assert docs.count() == 0


def test_one_row_of_each_component_stays(spark, docs_of):
    """Copies and near copies under one id or without an id go too; unlike texts under one id stay."""

    def text(name, last="z"):
        return " ".join([*(f"{name}{i}" for i in range(60)), last])

    rows = [(1, text("a")), (1, text("a")), (1, text("a", "y")), (1, text("b"))]
    rows += [(None, text("a", "x")), (None, text("c")), (None, text("c")), (None, text("c", "y")), (None, text("d")), (2, text("d"))]
    rows += [(5, text("e")), (5, text("e", "y")), (5, text("e", "y")), (4, text("e", "x")), (6, text("f")), (None, text("g"))]
    got = sorted(((r.doc_id, r.text.split()[0]) for r in stages.near_duplicates(spark, docs_of(*rows), SF_DIR).collect()), key=str)
    assert got == sorted([(1, "a0"), (1, "b0"), (None, "c0"), (2, "d0"), (4, "e0"), (6, "f0"), (None, "g0")], key=str)
