from __future__ import annotations

import random

import numpy as np
from ledgerline.llm import quality
from pyspark.sql import functions as F


def frames(spark, count=900):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(80)]
    docs, grades = [], []
    for i in range(count):
        grade = i % 3
        text = " ".join(rng.choices(words, k=40) + ["vile"] * (grade == 0) + ["$$$ !!!"] * 20 * (grade == 1))
        docs.append((i, text, "k"))
        if i < count * 2 // 3:
            grades.append((i, grade))
    docs += [(9000, None, "k"), (9001, "", "k"), (9002, "w1 " * 30_000, "k"), (None, "w2", "k")]
    grades += [(9000, 2), (None, 1), (9001, None), (3, 2)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, tail_probability string"),
        spark.createDataFrame(grades, "doc_id bigint, grade int"),
    )


def test_held_out_grades(spark):
    docs, grades = frames(spark)
    model = quality.fit(docs, grades, n_grades=3)
    assert np.all(np.diff(model.thresholds) > 0)
    got = quality.grade(docs, model, 2, "doc_id")
    rows = {r.doc_id: r for r in got.collect()}
    held = [rows[i] for i in range(600, 900)]
    assert len(rows) == 904 and all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in rows.values())
    assert np.mean([(r.tail_probability >= 0.5) == (r.doc_id % 3 == 2) for r in held]) > 0.95
    by_grade = [np.mean([r.expected_grade for r in held if r.doc_id % 3 == g]) for g in range(3)]
    assert by_grade == sorted(by_grade)


def test_the_sample_is_bounded_and_empty_input_works(spark):
    docs, grades = frames(spark)
    few = quality.fit(docs, grades, 3, sample_docs=5)
    assert few.weights.shape == (quality.DIMENSIONS,)
    none = quality.fit(docs.limit(0), grades.limit(0), 3)
    assert not none.weights.any() and none.thresholds.tolist() == [-0.5, 0.5]
    assert quality.grade(docs.limit(0), none, 2, "doc_id").count() == 0


def test_an_id_with_many_texts_teaches_by_one(spark):
    docs, grades = frames(spark, 120)
    others = spark.createDataFrame([(5, f"vile words number {i}", "k") for i in range(60)], docs.schema)
    many = docs.union(others).union(others)
    first = many.where("doc_id = 5").orderBy(F.xxhash64("text")).limit(1)
    want = quality.fit(docs.where("doc_id <> 5").union(first), grades, 3)
    got = quality.fit(many, grades, 3)
    assert np.allclose(got.weights, want.weights, atol=1e-6) and np.allclose(got.thresholds, want.thresholds, atol=1e-6)
