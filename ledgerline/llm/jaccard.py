"""N-gram Jaccard join by a count-vector R-tree.

A document's shingles are hashed into groups; the number of its shingles in each group makes it a point. Two
documents share at most the sum over the groups of the smaller count, so a pair whose sum stays below the overlap
that the similarity asks for can be left out. The number of groups grows with the document, so that counts stay
small and the bound sharp; points of unlike documents are folded to the smaller number. An R-tree over the points
applies the bound to whole nodes first: with a node's largest counts in place of a point's, the sum still bounds
every overlap of its members. What survives is verified on the full shingle sets.

The points are dealt out to trees by a lossless rule: in any fixed order of all shingles, two similar sets share
one of their first n - ceil(similarity * n) + 1. The order puts shingles of rare hash buckets first, by a sketch
of fixed size over all documents, so that passages many documents share deal out nothing as a rule. Equal sets
travel as one.

Work on large groups is kept down without leaving out links. First each set is compared with the smallest one of
each of its trees. What that links is one component already, and trees all of whose members are in one component
are done. Only trees that hold several components are searched, for pairs of different components; trees with
many members are cut into pairs of blocks, so a task holds a bounded number of points.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import arrow_rows, bloom_joins, components, drop_settled, selective, settle

WORDS = 5
PERCENT = 80
#: Groups of the shortest documents and of the tree's nodes; a document has a group for every 2 to 4 shingles.
GROUPS = 64
BUCKETS = 1 << 18
BLOCK = 512
LEAF = 16
BATCH = 256
_CACHED = 150_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


class _Words(dict):
    """Numbers for words as they are met, and the array of their hashes."""

    def __init__(self):
        super().__init__()
        self.hashes = np.zeros(1 << 16, np.uint64)

    def __missing__(self, word: bytes) -> int:
        n = len(self)
        if n == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
        self[word] = n
        self.hashes[n] = xxhash.xxh3_64_intdigest(word)
        return n


_words = _Words()


def _runs(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the runs of ``words`` words of each text in turn, and where each text's begin and end.

    A-Z are lower-cased and ASCII blanks part words (as bytes do); a text of fewer words is one run.
    """
    if len(_words) > _CACHED:
        _words.clear()
    split = [t.encode("utf-8", "replace").lower().split() if t else [] for t in texts]
    lengths = np.array([len(x) for x in split], np.int64)
    numbers = np.fromiter(map(_words.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(lengths.sum()))
    hashes = np.concatenate([_words.hashes[numbers], np.zeros(words, np.uint64)])
    ends = np.cumsum(lengths)
    begins = ends - lengths
    counts = np.where(lengths >= words, lengths - words + 1, np.minimum(lengths, 1))
    # the place of each run's first word, and how many words it has
    cuts = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(cuts[-1]) - np.repeat(cuts[:-1] - begins, counts)
    sizes = np.repeat(np.minimum(lengths, words), counts).astype(np.uint64)
    out = sizes.copy()
    short = sizes < words if (lengths < words).any() else None
    for i in range(words):
        step = (out ^ hashes[at + i]) * _MIX[0]
        step ^= step >> np.uint64(29)
        out = step if short is None else np.where(sizes > i, step, out)
    out = (out ^ out >> np.uint64(30)) * _MIX[1]
    out = (out ^ out >> np.uint64(27)) * _MIX[2]
    return out ^ out >> np.uint64(31), cuts


def _sorted_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct run hashes of each text."""
    runs, cuts = _runs(texts, words)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = np.sort(runs[a:b])
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if b - a > 1 else own)
    return out


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The same for one text."""
    return _sorted_sets([text], words)[0]


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-n * percent // 100) + 1 if n else 0


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The smallest shared count with 100 * shared >= percent * union."""
    return -(-(n + m) * percent // (100 + percent))


def _ranks(docs: DataFrame) -> np.ndarray:
    """How common the shingles of each hash bucket are, as the bits of the count: a sketch of fixed size.

    It only fixes the order in which shingles deal out documents, rare buckets first; any order is lossless.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for batch in arrow_rows(batches, BATCH):
            totals += np.bincount(_bucket(_runs(batch.column("text").to_pylist(), WORDS)[0]), minlength=BUCKETS)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(totals[used])], names=["bucket", "n"])

    counts = docs.select("text").where("text IS NOT NULL").mapInArrow(count, "bucket int, n long")
    bits = counts.groupBy("bucket").agg(F.sum("n").alias("n")).select("bucket", F.ceil(F.log2("n")).cast("byte").alias("bits")).toArrow()
    ranks = np.zeros(BUCKETS, np.uint64)
    ranks[bits.column("bucket").to_numpy()] = bits.column("bits").to_numpy()
    return ranks


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _sets(docs: DataFrame, percent: int) -> DataFrame:
    """Per row: doc_id, n, a 128-bit digest of the shingle set, the first shingles and the group counts."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    ranks = _ranks(docs)

    def first(hashes: np.ndarray) -> np.ndarray:
        # a tree's name is its place in the order: rank, then hash
        names = np.sort(ranks[_bucket(hashes)] << np.uint64(58) | hashes >> np.uint64(6))
        return names[: prefix_length(len(hashes), percent)].view(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH):
            found = _sorted_sets(batch.column("text").to_pylist())
            columns = [
                batch.column("doc_id"),
                pa.array([len(x) for x in found], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in found], pa.binary()),
                pa.array([first(x) for x in found], pa.list_(pa.int64())),
                pa.array([point(x).tobytes() for x in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "digest", "first", "point"])

    schema = f"doc_id {doc_type}, n long, digest binary, first array<long>, point binary"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def point(hashes: np.ndarray) -> np.ndarray:
    """Counts by group. Groups are the low bits of a uniform hash and hold a few shingles each, far from 2^16."""
    groups = GROUPS
    while 4 * groups < len(hashes):
        groups *= 2
    return np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype("<u2")


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """The same counts in fewer groups (along the last axis): a smaller mask of the hash merges every so-many-th."""
    if counts.shape[-1] == groups:
        return counts
    return counts.reshape(*counts.shape[:-1], -1, groups).sum(axis=-2, dtype=np.uint32)


def _points(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in column.to_pylist()]


def _shared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The bound for each of ``left`` with each of ``right`` (rows of counts)."""
    groups = min(left.shape[1], right.shape[1])
    left, right = folded(left, groups), folded(right, groups)
    return np.stack([np.minimum(x, right).sum(axis=1, dtype=np.int64) for x in left])


class _Tree:
    """A bulk-loaded R-tree of two levels over count vectors: points sorted by size and counts, leaves of ``LEAF``."""

    def __init__(self, n: np.ndarray, points: list[np.ndarray]):
        coarse = np.stack([folded(x, GROUPS) for x in points]).astype(np.int64) if len(n) else np.zeros((0, GROUPS), np.int64)
        self.order = np.lexsort((*coarse.T[:4], n)) if len(n) > LEAF else np.arange(len(n))
        self.n, coarse = n[self.order], coarse[self.order]
        self.starts = np.arange(0, len(n), LEAF)
        self.leaves = []
        for start in self.starts:
            own = [points[i] for i in self.order[start : start + LEAF]]
            groups = min(len(x) for x in own)
            self.leaves.append(np.stack([folded(x, groups) for x in own]))
        if len(n):
            self.top = np.maximum.reduceat(coarse, self.starts, axis=0)
            self.most, self.least = np.maximum.reduceat(self.n, self.starts), np.minimum.reduceat(self.n, self.starts)

    def pairs(self, other: _Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Members of either tree whose counts allow the similarity."""
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for leaf, start in enumerate(self.starts if len(other.n) else ()):
            # the leaves of the other tree that may hold a partner of some member of this leaf
            near = np.minimum(self.top[leaf], other.top).sum(axis=1) >= least_overlap(self.least[leaf], other.least, percent)
            near &= (other.most * 100 >= self.least[leaf] * percent) & (self.most[leaf] * 100 >= other.least * percent)
            if other is self:
                near[:leaf] = False
            mine = slice(start, start + LEAF)
            for found in np.flatnonzero(near):
                theirs = slice(other.starts[found], other.starts[found] + LEAF)
                bound = _shared(self.leaves[leaf], other.leaves[found])
                i, j = np.nonzero(bound >= least_overlap(self.n[mine, None], other.n[None, theirs], percent))
                left.append(i + start)
                right.append(j + other.starts[found])
        return self.order[np.concatenate(left)], other.order[np.concatenate(right)]


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that the count vectors allow."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = zip(_points(batch.column("point")), _points(batch.column("other")), strict=True)
            bound = np.array([int(_shared(x[None], y[None])[0, 0]) for x, y in points], np.int64)
            keep = bound >= least_overlap(batch.column("n").to_numpy(), batch.column("m").to_numpy(), percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = nodes.select(F.col("node").alias("a"), "n", "point")
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("point").alias("other"))
    both = pairs.join(left, "a").join(right, "b").where(f"100 * least(n, m) >= {percent} * greatest(n, m)")
    return both.select("a", "b", "n", "m", "point", "other").mapInArrow(work, pairs.select("a", "b").schema)


def _search(trees: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) in each tree that the counts allow and that are not in one component yet.

    ``trees(tree, left, right, block, node, n, point, root, trees)``: rows with equal (tree, left, right) are the
    members of one block or of two, which are then only compared with each other. ``trees`` has all searched trees
    of the node: a pair that several have in common is given by the first of them alone.
    """
    node_type = trees.schema["node"].dataType.simpleString()

    def one(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if rows["left"][0] == rows["right"][0]:
            at = [np.arange(len(rows["n"]))] * 2
        else:
            at = [np.flatnonzero(rows["block"] == rows[x][0]) for x in ("left", "right")]
        a = _Tree(rows["n"][at[0]], list(rows["point"][at[0]]))
        b = a if at[0] is at[1] else _Tree(rows["n"][at[1]], list(rows["point"][at[1]]))
        i, j = a.pairs(b, percent)
        i, j = at[0][i], at[1][j]
        keep = rows["root"][i] != rows["root"][j]
        i, j = i[keep], j[keep]
        if len(i):
            tree = rows["tree"][0]
            before = {k: {t for t in rows["trees"][k] if t < tree} for k in set(i.tolist()) | set(j.tolist())}
            first = np.array([before[x].isdisjoint(before[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)])
            i, j = i[first], j[first]
        i, j = rows["node"][i], rows["node"][j]
        return np.minimum(i, j), np.maximum(i, j)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "left", "right", "block", "node", "n", "root")}
            for c, values in (("point", _points(batch.column("point"))), ("trees", batch.column("trees").to_pylist())):
                rows[c] = np.empty(batch.num_rows, object)
                for k, value in enumerate(values):
                    rows[c][k] = value
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            new = np.zeros(len(rows["n"]), bool)
            for c in ("tree", "left", "right"):
                new[1:] |= rows[c][1:] != rows[c][:-1]
            cuts = [0, *np.flatnonzero(new).tolist()]
            yield from found([{c: v[a:b] for c, v in rows.items()} for a, b in zip(cuts, cuts[1:], strict=False)])
            held = {c: v[cuts[-1] :] for c, v in rows.items()}
        if held is not None and len(held["n"]):
            yield from found([held])

    def found(groups: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(groups), 1000):
            pairs = [one(x) for x in groups[at : at + 1000]]
            both = np.unique(np.concatenate([np.stack(x, axis=1) for x in pairs]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    together = trees.repartition("tree", "left", "right").sortWithinPartitions("tree", "left", "right")
    return together.mapInArrow(work, f"a {node_type}, b {node_type}").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of representatives whose full shingle sets are similar enough."""
    wanted = settle(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH):
            values = [x.astype("<u8").tobytes() for x in _sorted_sets(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.binary())], names=["node", "set"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    with bloom_joins(docs.sparkSession):
        given = docs.select("doc_id", "text").join(selective(wanted, "doc_id"), "doc_id", "left_semi")
        found = settle(given.mapInArrow(sets, f"node {doc_type}, set binary"), "shingle-sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH):
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                u, v = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                shared = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(100 * shared >= percent * (len(u) + len(v) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(found.select(F.col("node").alias("a"), F.col("set").alias("left")), "a")
    both = both.join(found.select(F.col("node").alias("b"), F.col("set").alias("right")), "b")
    links = settle(both.select("a", "b", "left", "right").mapInArrow(compare, f"a {doc_type}, b {doc_type}"), "links")
    drop_settled(found)
    return links


def join_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``: the smallest id reachable by links.

    Documents without words (or with a null text) have no shingles, link with nothing and are components of their
    own. Rows with a null id keep a null component and stand for no document. Rows that repeat an id are one
    document to whose texts links may lead; a component holds all ids reachable through any of them.
    """
    made = settle(_sets(docs, percent), "sets")
    sets = settle(made.select("doc_id", "n", "digest"), "digests")
    whole = made.where("doc_id IS NOT NULL AND n > 0")
    # equal sets are one node, named by their smallest id
    classes = settle(whole.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    named = whole.select("digest", F.col("doc_id").alias("node"), "n", "point", "first")
    firsts = settle(named.join(classes, ["digest", "node"], "left_semi"), "first-shingles")
    drop_settled(made)
    nodes = settle(firsts.select("node", "n", "point"), "nodes")
    dealt = firsts.select("node", F.explode("first").alias("tree"))
    trees = settle(dealt.groupBy("tree").agg(F.count("*").alias("members"), F.min("node").alias("pivot")).where("members > 1"), "trees")
    with bloom_joins(docs.sparkSession):
        members = settle(dealt.join(selective(trees, "tree"), "tree"), "members")
    drop_settled(firsts)

    star = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    first = _verified(settle(_near(star, nodes, percent), "stars"), docs, percent)
    roots = components(first)
    rooted = settle(members.join(roots, "node", "left").select("tree", "members", "node", F.coalesce("root", "node").alias("root")), "rooted")
    # trees of several components; those with the same members are searched once
    alike = [F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")]
    mixed = rooted.groupBy("tree").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"), *alike)
    mixed = settle(mixed.where("low < high").groupBy("size", "x", "y").agg(F.min("tree").alias("tree")).select("tree"), "mixed")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    searched = settle(rooted.join(mixed, "tree"), "searched")
    points = nodes.select("node", "n", "point").join(searched.groupBy("node").agg(F.collect_set("tree").alias("trees")), "node")
    cut = searched.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cut = cut.withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other"))
    cut = cut.join(points, "node").select("tree", "left", "right", "block", "node", "n", "point", "root", "trees")
    second = _verified(settle(_search(cut, percent), "pairs"), docs, percent)
    drop_settled(nodes, members, rooted, searched)

    # an id with several texts holds their nodes together
    own = sets.where("doc_id IS NOT NULL AND n > 0").select("digest", "doc_id").distinct().join(classes, "digest").groupBy("doc_id").agg(F.collect_set("node").alias("nodes")).where("size(nodes) > 1")
    same = own.select(F.array_min("nodes").alias("a"), F.explode("nodes").alias("b"))
    roots = components(first.union(second).union(same))
    found = sets.select("doc_id", "n", "digest").join(classes, "digest", "left").join(roots, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", F.when(F.col("n") > 0, F.col("node")), "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
