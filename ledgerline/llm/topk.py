"""Exact top-k inner-product search by block-at-a-time pruning.

Rows are cut into ranges of ids ("blocks"). A block keeps its rows as a small forward index (a row-major
integer matrix) and, per vector component ("term"), the largest and smallest value in it. For a query, the
sum of the larger of q*max and q*min over its components bounds every score in the block. Blocks are taken
in the order of that bound: the best few are scored first and give a k-th score; of the others only those
whose bound reaches it are scored. Nothing is approximated.

Queries are a stated set and travel in blocks too, so all joins are on (query block, block) keys and tasks
hold a bounded number of rows of either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.common import settle

BLOCK_ROWS = 512
QUERY_ROWS = 64
GROUP_BLOCKS = 256
SEED_BLOCKS = 4
#: float64 sums of integers are exact below this.
_EXACT = 2**53
#: Below every score.
_NONE = -(2**63)


def quantise(embedding: Column, scale: int = 1024) -> Column:
    """Integer components floor(scale * x), or null when the vector is null or has a null or non-finite one."""
    doubles = F.transform(embedding, lambda x: x.cast("double"))
    good = embedding.isNotNull() & ~F.exists(
        doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return F.when(good, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def _blocks(rows: DataFrame, size: int, label: str) -> DataFrame:
    """(block, ids, values, width, top, low): ``size`` rows each, in ranges of ids."""
    schema = "block long, ids array<long>, values binary, width int, top array<long>, low array<long>"

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number, rest = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            rest.extend(zip(batch.id.tolist(), batch.vector.tolist(), strict=True))
            while len(rest) >= size:
                yield _packed(number, rest[:size])
                number, rest = number + 1, rest[size:]
        if rest:
            yield _packed(number, rest)

    ranged = rows.repartitionByRange("id").sortWithinPartitions("id")
    return settle(ranged.mapInPandas(cut, schema), label)


def _packed(number: int, rows: list) -> pd.DataFrame:
    width = max((len(v) for _, v in rows), default=0)
    matrix = np.zeros((len(rows), width), dtype=np.int64)
    for i, (_, v) in enumerate(rows):
        matrix[i, : len(v)] = v
    return pd.DataFrame(
        {
            "block": [number],
            "ids": [np.array([i for i, _ in rows], dtype=np.int64)],
            "values": [matrix.tobytes()],
            "width": [width],
            "top": [matrix.max(axis=0) if width else np.zeros(0, np.int64)],
            "low": [matrix.min(axis=0) if width else np.zeros(0, np.int64)],
        }
    )


def _matrix(values: bytes, width: int, count: int) -> np.ndarray:
    return np.frombuffer(values, dtype=np.int64).reshape(count, width)


def _product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in integers; vectors of other lengths count as padded with zeros."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * width
    if most < _EXACT:
        return np.rint(left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def _bound(queries: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each query and block, no score is above this."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return _product(up, top) + _product(down, low)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest integer inner products for each query row.

    Candidates are all rows but those with the query's own id; ties go to the smaller id. Rows with a null id
    or an unusable vector (see ``quantise``) take no part; rows that repeat an id are one query, by the least of their
    vectors in order of components, and separate candidates of others. Vectors of unequal length count as padded with zeros. Scores must fit
    a long. An empty table gives an empty result.
    """
    good = vectors.select(
        F.col(id_col).cast("long").alias("id"), quantise(F.col(vector_col)).alias("vector"), is_query.alias("asked")
    ).where("id IS NOT NULL AND vector IS NOT NULL")
    index = _blocks(good, BLOCK_ROWS, "vector-blocks")
    queries = _blocks(good.where("asked").groupBy("id").agg(F.min("vector").alias("vector")), QUERY_ROWS, "query-blocks")
    queries = queries.select(F.col("block").alias("q"), F.col("ids").alias("q_ids"), F.col("values").alias("q_values"), F.col("width").alias("q_width"))

    # block summaries in groups of bounded size, each met by each query block
    groups = max(1, index.count() // GROUP_BLOCKS)
    numbered = index.select(F.col("block").alias("b"), "top", "low", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("g"))
    summaries = numbered.groupBy("g").agg(F.collect_list(F.struct("b", "top", "low")).alias("blocks"))
    met = queries.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>"))).join(summaries, "g")

    seeds = met.mapInPandas(_seeds, "id long, q long, block long, bound long")
    order = Window.partitionBy("id").orderBy(F.desc("bound"), "block")
    first = settle(seeds.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SEED_BLOCKS).select("id", "q", "block", F.lit(_NONE).alias("floor")), "seeds")
    begun = settle(_scored(first, queries, index, k), "seed-scores")
    by_score = Window.partitionBy("id").orderBy(F.desc("score"), "vec_id")
    kth = begun.withColumn("n", F.row_number().over(by_score)).where(F.col("n") == k).select("id", F.col("score").alias("kth"))
    floors = kth.join(queries.select("q", F.explode("q_ids").alias("id")), "id", "right").groupBy("q").agg(
        F.map_from_entries(F.collect_list(F.struct("id", F.coalesce("kth", F.lit(_NONE))))).alias("floors")
    )
    wanted = met.join(floors, "q").mapInPandas(_above, "id long, q long, block long, floor long")
    rest = wanted.join(first.select("id", "q", "block"), ["id", "q", "block"], "left_anti")
    all_scores = begun.unionByName(_scored(rest, queries, index, k))
    ranked = all_scores.withColumn("rank", F.row_number().over(by_score).cast("int")).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", "vec_id", "score")


def _bounds_of(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.asarray(row.q_ids, dtype=np.int64)
    queries = _matrix(row.q_values, row.q_width, len(ids))
    width = max(len(x["top"]) for x in row.blocks)
    top, low = (np.array([np.pad(x[n], (0, width - len(x[n]))) for x in row.blocks], dtype=np.int64) for n in ("top", "low"))
    return ids, np.array([x["b"] for x in row.blocks], dtype=np.int64), _bound(queries, top, low)


def _seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The blocks with the highest bounds of each query, of each group of blocks."""
    for batch in batches:
        for row in batch.itertuples():
            ids, blocks, bounds = _bounds_of(row)
            best = np.argsort(-bounds, axis=1, kind="stable")[:, :SEED_BLOCKS]
            yield pd.DataFrame(
                {
                    "id": np.repeat(ids, best.shape[1]),
                    "q": row.q,
                    "block": blocks[best].ravel(),
                    "bound": np.take_along_axis(bounds, best, axis=1).ravel(),
                }
            )


def _above(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The blocks whose bound reaches the query's k-th score so far; ties may still win by a smaller id."""
    for batch in batches:
        for row in batch.itertuples():
            ids, blocks, bounds = _bounds_of(row)
            known = dict(row.floors)
            floors = np.array([known[x] for x in ids.tolist()], dtype=np.int64)
            i, j = np.nonzero(bounds >= floors[:, None])
            yield pd.DataFrame({"id": ids[i], "q": row.q, "block": blocks[j], "floor": floors[i]})


def _scored(wanted: DataFrame, queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """The k best of each wanted (query, block) that reach the query's floor, by the block's forward index."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [_best_of(row, k) for row in batch.itertuples()]
            if parts:
                found = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pd.DataFrame(dict(zip(("id", "vec_id", "score"), found, strict=True)))

    grouped = wanted.groupBy("q", "block").agg(F.collect_list("id").alias("asked"), F.collect_list("floor").alias("floors"))
    full = grouped.join(index.select("block", "ids", "values", "width"), "block").join(queries, "q")
    return full.mapInPandas(score, "id long, vec_id long, score long")


def _best_of(row, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of one query block against one block of rows, ties to the smaller ids."""
    ids, own, asked = (np.asarray(x, dtype=np.int64) for x in (row.ids, row.q_ids, row.asked))
    order = np.argsort(own)
    at = order[np.searchsorted(own, asked, sorter=order)]
    scores = _product(_matrix(row.q_values, row.q_width, len(own))[at], _matrix(row.values, row.width, len(ids)))
    scores[asked[:, None] == ids[None, :]] = _NONE
    least = np.maximum(np.asarray(row.floors, dtype=np.int64), _NONE + 1)
    if len(ids) > k:
        least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
    q, i = np.nonzero(scores >= least[:, None])
    found = scores[q, i]
    order = np.lexsort((ids[i], -found, q))
    q, i, found = q[order], i[order], found[order]
    first = np.searchsorted(q, q)  # ties at the end of the list are cut by id
    keep = np.arange(len(q)) - first < k
    return asked[q[keep]], ids[i[keep]], found[keep]
