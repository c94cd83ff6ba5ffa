"""Document quality by ordinal cumulative-link regression on graded ratings.

P(grade <= j) = sigmoid(threshold_j - w.x): all grades share the weights w of the hashed text features, and the
thresholds are ordered (each is the one before plus a positive step). The model gives an expected grade and the
probability of reaching a grade, by which documents are selected.

Features are the distinct lower-cased words of the whole text, hashed, and a few shares of character kinds.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import arrow_rows

BITS = 20
SHAPES = 8
DIMENSIONS = (1 << BITS) + SHAPES
#: Labelled documents that the model is fitted on, at most: those with the smallest hashed ids.
SAMPLE_DOCS = 16_000
#: Words seen in fewer sampled documents get no weight.
LEAST_DOCS = 4
STEPS, RATE, RIDGE = 160, 0.05, 2e-4
BATCH = 512


@dataclass(frozen=True)
class GradeModel:
    weights: np.ndarray  # DIMENSIONS
    thresholds: np.ndarray  # grades - 1, increasing


def shapes(text: str) -> list[float]:
    """Bounded shares that tell layout junk from prose: symbols, digits, capitals, repeats, length."""
    n = max(1, len(text))
    ascii_text = text.encode("ascii", "ignore")
    capitals = n - len(ascii_text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")) - (n - len(ascii_text))
    digits = len(ascii_text) - len(ascii_text.translate(None, b"0123456789"))
    symbols = len(ascii_text) - len(ascii_text.translate(None, b"!#$%&*+/<=>@[\\]^_`{|}~"))
    words = text.split()
    distinct = len(set(words)) / max(1, len(words))
    lines = text.split("\n")
    repeated = 1 - len(set(lines)) / len(lines)
    return [1.0, min(1, 5 * symbols / n), min(1, 5 * digits / n), min(1, 2 * capitals / n), distinct, repeated, min(1, math.log1p(len(words)) / 10), min(1, n / max(1, len(words)) / 20)]


def _buckets(text: str) -> list[int]:
    return [zlib.crc32(w) >> (32 - BITS) for w in set(text.lower().encode("utf-8", "replace").split())]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrow_rows(batches, BATCH):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "grade": batch.column("grade"),
                "buckets": pa.array([sorted(set(_buckets(t))) for t in texts], pa.list_(pa.int32())),
                "shapes": pa.array([shapes(t) for t in texts], pa.list_(pa.float64())),
            }
        )


def fit(docs: DataFrame, grades: DataFrame, n_grades: int, sample_docs: int = SAMPLE_DOCS) -> GradeModel:
    """Fit on the documents that ``grades(doc_id, grade)`` rates, 0 to ``n_grades - 1``.

    At most ``sample_docs`` rated documents are used, chosen by the hash of their ids; only their hashed features
    meet in the one fitting task. Ids rated twice keep the lowest grade; of the texts under one id that of the smallest
    hash teaches, once, so repeated ids do not widen the task; null ids, grades or texts teach nothing. Words in fewer
    than ``LEAST_DOCS`` of the documents used get no weight. With no usable row the weights are zero and the thresholds
    evenly spaced.
    """
    rated = grades.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    picked = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(picked), "doc_id")
    one = texts.groupBy("doc_id", "grade").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text"))
    featured = one.select("grade", "text").mapInArrow(_features, "grade int, buckets array<int>, shapes array<double>")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        model = _train(pa.Table.from_batches(tables) if tables else None, n_grades)
        used = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_pydict({"at": pa.array([used.astype(np.int32)], pa.list_(pa.int32())), "w": pa.array([model.weights[used]], pa.list_(pa.float64())), "t": pa.array([model.thresholds], pa.list_(pa.float64()))})

    (row,) = featured.coalesce(64).repartition(1).mapInArrow(train, "at array<int>, w array<double>, t array<double>").collect()
    weights = np.zeros(DIMENSIONS)
    weights[row["at"]] = row["w"]
    return GradeModel(weights, np.array(row["t"]))


def _train(table: pa.Table | None, n_grades: int) -> GradeModel:
    """Adam on the mean log likelihood with a ridge; the design is sparse, rows in a fixed order."""
    thresholds = np.arange(n_grades - 1) - (n_grades - 2) / 2.0
    if table is None:
        return GradeModel(np.zeros(DIMENSIONS), thresholds)
    table = table.combine_chunks()
    grade = np.clip(table.column("grade").to_numpy().astype(np.int64), 0, n_grades - 1)
    lists = table.column("buckets").combine_chunks()
    offsets, values = lists.offsets.to_numpy().astype(np.int64), lists.flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(grade)), np.diff(offsets))
    common = np.bincount(values, minlength=1 << BITS) >= LEAST_DOCS
    row, values = row[common[values]], values[common[values]]
    used, column = np.unique(values, return_inverse=True)
    dense = np.array(table.column("shapes").to_pylist())[:, 1:]
    m, d = len(used), dense.shape[1]
    x = np.concatenate([np.zeros(m + d), thresholds[:1], np.zeros(n_grades - 2)])  # weights, first threshold, log steps
    first, second = np.zeros_like(x), np.zeros_like(x)
    n = len(grade)
    for step in range(1, STEPS + 1):
        steps = np.exp(x[m + d + 1 :])
        cuts = np.concatenate([[-np.inf], x[m + d] + np.concatenate([[0.0], np.cumsum(steps)]), [np.inf]])
        score = np.bincount(row, weights=x[column], minlength=n) + dense @ x[m : m + d]
        upper, lower = _sigmoid(cuts[grade + 1] - score), _sigmoid(cuts[grade] - score)
        mass = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        by_score = (up - low) / n  # of minus the log likelihood
        g = np.zeros_like(x)
        g[:m] = np.bincount(column, weights=by_score[row], minlength=m)
        g[m : m + d] = dense.T @ by_score
        by_cut = np.zeros(n_grades + 1)
        np.add.at(by_cut, grade + 1, -up / n)
        np.add.at(by_cut, grade, low / n)
        inner = by_cut[1:-1]
        g[m + d] = inner.sum()
        g[m + d + 1 :] = np.cumsum(inner[::-1])[::-1][1:] * steps
        g[: m + d] += RIDGE * x[: m + d]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        x -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(DIMENSIONS)
    weights[used] = x[:m]
    weights[(1 << BITS) + 1 : (1 << BITS) + 1 + d] = x[m : m + d]
    return GradeModel(weights, x[m + d] + np.concatenate([[0.0], np.cumsum(np.exp(x[m + d + 1 :]))]))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def grade(docs: DataFrame, model: GradeModel, tail: int, *keep: str | Column) -> DataFrame:
    """``keep`` columns with ``expected_grade`` and ``tail_probability`` = P(grade >= ``tail``), for every row.

    Null texts count as empty. Whole texts are read, whatever their length.
    """
    schema = docs.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    shaped, worded = model.weights[1 << BITS :], model.weights[: 1 << BITS].astype(np.float32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH):
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            scores = np.array([worded[np.unique(np.array(_buckets(t), dtype=np.int64))].sum(dtype=np.float64) + shaped @ shapes(t) for t in texts])
            above = 1 - _sigmoid(model.thresholds[None, :] - scores[:, None])  # P(grade > j)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(above.sum(axis=1), pa.float64()), pa.array(above[:, tail - 1], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "expected_grade", "tail_probability"])

    given = docs.select(*keep, F.col("text").alias("__text"))
    return given.mapInArrow(work, f"{fields}, expected_grade double, tail_probability double")
