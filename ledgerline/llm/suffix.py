"""Removal of repeated byte strings by a distributed difference-cover suffix array.

Every byte that lies in a ``WINDOW``-byte string which also starts anywhere else is removed.

Reducing the text, without losing a match. The hash minimum over a window's ``GRAM``-byte strings depends on the
window alone, so equal windows have equal minima ("anchors"), at the same place in them. Neighbouring windows with
the same anchor form a segment. A segment whose anchor's hash occurs nowhere else holds no repeated window. Equal
segments travel as one, with their number.

Suffix array. Relative to its anchor, a segment is cut into blocks of ``BLOCK`` bytes; wherever a window begins, it
holds ``DEPTH`` whole blocks. The suffixes of all segments at block borders are sorted by difference cover: those at
places 1 and 2 modulo 3 are sampled, their triples of blocks sorted and named, and the strings of names sorted by
recursion; a suffix at place 0 is ordered by its first block and the rank of the next, and merged with the sampled
ones by where it falls among those of place 1 (first block, rank of the next) and of place 2 (two blocks, rank of
the one after). All sorts are range-partitioned; ties are split by a hash, so no equal keys have to meet in a task.

Adjacent prefixes are then compared: suffixes in a row that agree in ``DEPTH`` blocks are a group. A window repeats
if another member of its group agrees in the bytes before the blocks and after them as well; that is settled for
whole ranges of begins first, and range by range only where members differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import arrow_rows, bloom_joins, drop_settled, selective, settle

WINDOW = 400
GRAM = 64
BLOCK = 40
DEPTH = WINDOW // BLOCK - 1
#: Widths of the ranges of window begins that are settled together.
WIDTHS = (BLOCK, 8, 1)
BATCH = 128
PIECE = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_LOWEST = -(2**63)


def _hash64(data: bytes) -> int:
    found = xxhash.xxh3_64_intdigest(data)
    return max(found - (1 << 64) if found >> 63 else found, _LOWEST + 1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on, built by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    size, factor = 1, 0x94D049BB133111EB
    while size < GRAM:
        h = h[:-size] * np.uint64(factor) + h[size:]
        h ^= h >> np.uint64(31)
        size, factor = 2 * size, (factor * factor + 2) % 2**64
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, lo, hi, at, anchor): windows begin from ``lo`` to ``hi`` and share the anchor at ``at``."""
    out: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for start in range(0, max(0, len(text) - WINDOW + 1), PIECE):
            part = text[start : start + PIECE + WINDOW - 1]
            if held and size + len(part) > 2 * PIECE - WINDOW:
                out.append(_segments_of(held))
                held, size = [], 0
            held.append((i, start, part))
            size += len(part)
    if held:
        out.append(_segments_of(held))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 5


def _segments_of(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    h = _gram_hashes(data)
    key = h & ~_PLACE | np.arange(len(h), dtype=np.uint64)
    span, size = WINDOW - GRAM + 1, 1
    least = key
    while 2 * size <= span:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    least = np.minimum(least[: len(key) - span + 1], least[span - size : span - size + len(key) - span + 1])
    lengths = np.array([len(p) for _, _, p in parts])
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(parts)), lengths)[: len(least)]
    begins = np.flatnonzero(np.arange(len(least)) + WINDOW <= ends[owner])  # windows within one text
    owner, least = owner[begins], least[begins]
    new = np.ones(len(begins), bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(begins)) - 1
    shift = np.array([start for _, start, _ in parts])[owner[first]] - (ends - lengths)[owner[first]]
    text = np.array([i for i, _, _ in parts])[owner[first]]
    at = (least[first] & _PLACE).astype(np.int64)
    return text, begins[first] + shift, begins[last] + shift, at + shift, (least[first] >> np.uint64(20)).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    """The bytes of each text; of none, if it is null."""
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _found_segments(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH):
            texts = _texts(batch)
            text, lo, hi, at, anchor = segments(texts)
            content = [xxhash.xxh3_128_digest(texts[i][a : b + WINDOW]) for i, a, b in zip(text.tolist(), lo.tolist(), hi.tolist(), strict=True)]
            rows = pa.array(text, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(rows), batch.column("key").take(rows), *(pa.array(x, pa.int64()) for x in (lo, hi, at, anchor)), pa.array(content, pa.binary())],
                names=["doc", "key", "lo", "hi", "at", "anchor", "content"],
            )

    return docs.mapInArrow(work, "doc long, key long, lo long, hi long, at long, anchor long, content binary")


def _strings(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, m, first, back, ahead, chars, data): a class's bytes, and the hashes of its blocks.

    Block ``first + j`` is ``chars[j]``; windows begin from ``back`` bytes before the anchor to ``back - ahead``.
    """
    wanted = classes.groupBy("doc", "key").agg(F.collect_list(F.struct("id", "m", "lo", "hi", "at")).alias("wanted"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH):
            rows = []
            for data, own in zip(_texts(batch), batch.column("wanted").to_pylist(), strict=True):
                for x in own:
                    part, back = data[x["lo"] : x["hi"] + WINDOW], x["at"] - x["lo"]
                    first = -(back // BLOCK)
                    starts = range(back + BLOCK * first, len(part) - BLOCK + 1, BLOCK)
                    rows.append((x["id"], x["m"], first, back, x["hi"] - x["lo"], [_hash64(part[s : s + BLOCK]) for s in starts], part))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["id", "m", "first", "back", "ahead", "chars", "data"])

    schema = "id long, m long, first long, back long, ahead long, chars array<long>, data binary"
    wanted = settle(wanted, "wanted-strings")
    with bloom_joins(docs.sparkSession):
        out = settle(docs.join(selective(wanted, "key"), ["doc", "key"]).mapInArrow(work, schema), "strings")
    drop_settled(wanted)
    # rows that repeat a whole document give its strings again
    return out if out.count() == classes.count() else settle(out.dropDuplicates(["id"]), "strings")


def _ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Sorted over all partitions; rows with equal keys are spread by a hash of (id, j)."""
    tied = df.withColumn("tie", F.xxhash64("id", "j"))
    return tied.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie").drop("tie")


def _small(spark: SparkSession, rows: list[tuple[int, int]], *names: str) -> DataFrame:
    """A few rows of longs; as an Arrow table they need no Python task."""
    return spark.createDataFrame(pa.table({name: pa.array([r[i] for r in rows], pa.int64()) for i, name in enumerate(names)}))


def _lists(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(id, ``name``): the values of each id, in the order of j; no id has more than the blocks of a segment."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed(ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(ids)).astype(np.int32)), pa.array(values))
            return pa.RecordBatch.from_arrays([pa.array(ids[starts]), lists], names=["id", name])

        ids, values = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            # the last id may go on in the next batch
            ids, values = (np.concatenate((old, batch.column(c).to_numpy())) for old, c in ((ids, "id"), (values, value)))
            starts = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1))
            if len(starts) > 1:
                yield listed(ids[: starts[-1]], values[: starts[-1]], starts[:-1])
                ids, values = ids[starts[-1] :], values[starts[-1] :]
        if len(ids):
            yield listed(ids, values, np.zeros(1, np.int64))

    dealt = rows.select("id", "j", value).repartition("id").sortWithinPartitions("id", "j")
    return dealt.select("id", value).mapInArrow(work, f"id long, {name} array<long>")


def _insertions(df: DataFrame, *keys: str) -> DataFrame:
    """For each row without a rank, the largest rank before it in the order of ``keys``: (id, j, c0, n1, place)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, most = TaskContext.get().partitionId(), _LOWEST
        names = ["id", "j", "c0", "n1", "place", "part"]
        for batch in batches:
            rank = batch.column("rank").fill_null(_LOWEST).to_numpy()
            place = np.maximum(np.maximum.accumulate(rank), most) if len(rank) else rank
            most = int(place[-1]) if len(place) else most
            out = [*(batch.column(c) for c in names[:4]), pa.array(place), pa.array(np.full(len(place), part))]
            yield pa.RecordBatch.from_arrays(out, names=names).filter(batch.column("rank").is_null())
        end = [pa.array([None], pa.int64())] * 4 + [pa.array([most]), pa.array([part])]
        yield pa.RecordBatch.from_arrays(end, names=names)

    schema = "id long, j long, c0 long, n1 long, place long, part long"
    found = settle(_ordered(df, *keys).mapInArrow(work, schema), "insertions", unlike=("id", "c0", "n1", "place"))
    # what the partitions before reach, by partition
    most, before = _LOWEST, []
    for row in found.where("id IS NULL").select("part", "place").orderBy("part").collect():
        before.append((row["part"], most))
        most = max(most, row["place"])
    carried = _small(found.sparkSession, before, "part", "before")
    return found.where("id IS NOT NULL").join(F.broadcast(carried), "part").select("id", "j", "c0", "n1", F.greatest("place", "before").alias("place"))


def suffix_ranks(strings: DataFrame, depth: int) -> DataFrame:
    """``(id, ranks)``: where each suffix of ``chars`` falls among all suffixes of all ``strings(id, chars)``.

    The order is right for suffixes that differ within their first ``depth`` chars; others are in any order. A
    string's end sorts before all chars.
    """
    if depth <= 1:
        return strings.select("id", F.col("chars").alias("ranks"))
    low = F.lit(_LOWEST)
    each = strings.select("id", "chars", F.posexplode("chars").alias("j", "c0")).withColumn("j", F.col("j").cast("long"))

    def char(k: int):
        return F.coalesce(F.get("chars", (F.col("j") + k).cast("int")), low)

    # sampled triples get names in their order
    sample = each.where("j % 3 <> 0").select("id", "j", "c0", char(1).alias("c1"), char(2).alias("c2"))
    triples = sample.select("c0", "c1", "c2").distinct().repartitionByRange("c0", "c1", "c2").sortWithinPartitions("c0", "c1", "c2")
    names = settle(triples.withColumn("name", F.monotonically_increasing_id()), "names", unlike=("c0", "c1", "c2", "name"))
    named = sample.join(names, ["c0", "c1", "c2"]).select((F.col("id") * 2 + F.col("j") % 3 - 1).alias("id"), "j", "name")
    chains = settle(_lists(named, "name", "chars"), "chains", unlike=("id", "chars.list.element"))
    deeper = suffix_ranks(chains, -(-depth // 3))
    own = [F.max(F.when(F.col("id") % 2 == k, F.col("ranks"))).alias(f"r{k + 1}") for k in (0, 1)]
    ranks = deeper.groupBy(F.floor(F.col("id") / 2).alias("of")).agg(*own)

    # the remaining suffixes are merged in
    def rank(k: int):
        at = F.col("j") + k
        third = F.floor(at / 3).cast("int")
        return F.when(at % 3 == 1, F.coalesce(F.get("r1", third), low)).when(at % 3 == 2, F.coalesce(F.get("r2", third), low))

    joined = strings.join(ranks, strings.id == ranks.of, "left").select("id", "chars", "r1", "r2", F.posexplode("chars").alias("j", "c0"))
    joined = joined.withColumn("j", F.col("j").cast("long"))
    suffixes = settle(joined.select("id", "j", "c0", char(1).alias("c1"), rank(0).alias("rank"), rank(1).alias("n1"), rank(2).alias("n2")), "suffixes", unlike=("c0", "c1", "rank", "n1", "n2"))
    drop_settled(names, chains)
    ones = _insertions(suffixes.where("j % 3 <> 2"), "c0", "n1")
    twos = _insertions(suffixes.where("j % 3 <> 1"), "c0", "c1", "n2")
    placed = ones.union(twos).groupBy("id", "j").agg(F.max("place").alias("place"), F.lit(1).alias("late"), F.max("c0").alias("c0"), F.max("n1").alias("n1"))
    zero = F.lit(0).cast("long")
    sampled = suffixes.where("j % 3 <> 0").select("id", "j", F.col("rank").alias("place"), F.lit(0).alias("late"), zero.alias("c0"), zero.alias("n1"))
    order = _ordered(sampled.unionByName(placed), "place", "late", "c0", "n1").select("id", "j", F.monotonically_increasing_id().alias("rank"))
    order = settle(order, "order", unlike=("id", "rank"))
    out = settle(_lists(order, "rank", "ranks"), "ranks", unlike=("id", "ranks.list.element"))
    drop_settled(suffixes, order)
    return out


def _groups(strings: DataFrame, ranks: DataFrame) -> DataFrame:
    """(g, id, j, m, lo, hi): suffixes in groups that agree in ``DEPTH`` blocks, and how far before them windows begin."""
    block = (F.col("first") + F.col("j")) * BLOCK
    starts = strings.select("id", "m", "first", "back", "ahead", "chars").join(ranks, "id")
    starts = starts.select("id", "m", "first", "back", "ahead", "chars", F.posexplode("ranks").alias("j", "rank"))
    starts = starts.select(
        "id", "m", F.col("j").cast("long").alias("j"), "rank",
        F.greatest(F.lit(0), block + F.col("back") - F.col("ahead")).cast("int").alias("lo"),
        F.least(F.lit(BLOCK - 1), block + F.col("back")).cast("int").alias("hi"),
        F.slice("chars", F.col("j") + 1, DEPTH).alias("prefix"),
    ).where((F.col("lo") <= F.col("hi")) & (F.size("prefix") == DEPTH))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, group, opening = TaskContext.get().partitionId(), None, None, True
        names = ["g", "id", "j", "m", "lo", "hi", "part", "opening", "prefix"]
        for batch in batches:
            if not batch.num_rows:
                continue
            prefix = np.asarray(batch.column("prefix").flatten()).reshape(-1, DEPTH)
            rank = batch.column("rank").to_numpy()
            same = np.zeros(len(rank), bool)
            same[1:] = (prefix[1:] == prefix[:-1]).all(axis=1)
            same[0] = last is not None and bool((prefix[0] == last).all())
            heads = np.maximum.accumulate(np.where(same, -1, np.arange(len(rank))))
            g = np.where(heads >= 0, rank[np.maximum(heads, 0)], group if group is not None else 0)
            open_ = np.zeros(len(rank), bool) if not opening else (heads < 0) | (heads == 0) & (group is None)
            first = prefix[:1].tolist() if group is None else [None]
            marks = pa.array(first + [None] * (len(rank) - 1), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(g), *(batch.column(c) for c in names[1:6]), pa.array(np.full(len(rank), part)), pa.array(open_), marks], names=names)
            opening, last, group = opening and bool(open_[-1]), prefix[-1], int(g[-1])
        if last is not None:
            end = [pa.array([group]), pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([0], pa.int32()), pa.array([0], pa.int32()), pa.array([part]), pa.array([opening]), pa.array([last.tolist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(end, names=names)

    schema = "g long, id long, j long, m long, lo int, hi int, part long, opening boolean, prefix array<long>"
    found = settle(_ordered(starts, "rank").mapInArrow(work, schema), "groups")
    # a partition's first group may go on from the one before
    edges: dict[int, dict[str, object]] = {}
    for row in found.where("prefix IS NOT NULL").select("g", "id", "part", "opening", "prefix").collect():
        edges.setdefault(row["part"], {})["last" if row["id"] is None else "first"] = row
    moved, last, group = [], None, None
    for part in sorted(edges):
        first, end = edges[part]["first"], edges[part]["last"]
        goes_on = last is not None and list(first["prefix"]) == last
        if goes_on:
            moved.append((part, group))
        last = list(end["prefix"])
        group = group if goes_on and end["opening"] else end["g"]
    moves = _small(found.sparkSession, moved, "part", "to")
    joined = found.where("id IS NOT NULL").join(F.broadcast(moves), "part", "left")
    return joined.select(F.when(F.col("opening"), F.coalesce("to", "g")).otherwise(F.col("g")).alias("g"), "id", "j", "m", "lo", "hi")


def _sides(groups: DataFrame, strings: DataFrame) -> DataFrame:
    """The members of groups of two or more, with the bytes before and after the common blocks."""
    large = groups.groupBy("g").agg(F.sum("m").alias("n")).where("n > 1").select("g")
    members = groups.join(large, "g", "left_semi").groupBy("id").agg(F.collect_list(F.struct("g", "j", "lo", "hi")).alias("own"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 4 * BATCH):
            rows = []
            for id_, m, first, back, data, own in zip(*(batch.column(c).to_pylist() for c in ("id", "m", "first", "back", "data", "own")), strict=True):
                for x in own:
                    at = back + BLOCK * (first + x["j"])
                    rows.append((x["g"], id_, at, m, x["lo"], x["hi"], data[at - x["hi"] : at], data[at + DEPTH * BLOCK : at + WINDOW - x["lo"]]))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["g", "id", "at", "m", "lo", "hi", "left", "right"])

    joined = strings.select("id", "m", "first", "back", "data").join(members, "id")
    return joined.mapInArrow(work, "g long, id long, at long, m long, lo int, hi int, left binary, right binary")


def _cells(rows: DataFrame, width: int) -> DataFrame:
    """Ranges of ``width`` begins, with a hash of what all their windows share and of all that they cover."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 16 * BATCH):
            out = []
            for g, id_, at, m, lo, hi, left, right, done in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for cell in range(lo // width, hi // width + 1):
                    low, high = cell * width, cell * width + width - 1
                    # any window of the cell holds ``low`` bytes before the blocks and the rest but ``high`` after
                    core = _hash64(b"%d %d %d " % (g, cell, width) + left[len(left) - low :] + b" " + right[: BLOCK - high])
                    a, b = max(lo, low), min(hi, high)
                    whole = _hash64(b"%d %d-%d " % (g, a, b) + left[len(left) - b :] + b" " + right[: BLOCK - a])
                    out.append((g, id_, at, m, a, b, left[len(left) - b :], right[: BLOCK - a], done, core, whole))
            columns = list(zip(*out, strict=True)) or [()] * 11
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()] * 2 + [pa.bool_()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=[*batch.schema.names, "core", "whole"])

    schema = "g long, id long, at long, m long, lo int, hi int, left binary, right binary, done boolean, core long, whole long"
    return rows.mapInArrow(work, schema)


def _repeated(sides: DataFrame) -> DataFrame:
    """(id, start, end): the bytes of each string that its repeated windows cover.

    Ranges that are settled stay as partners of others for as long as those are open.
    """
    rows, found = sides.withColumn("done", F.lit(False)), None
    for width in WIDTHS:
        cells = settle(_cells(rows, width), "cells")
        twice = cells.groupBy("g", "whole").agg(F.sum("m").alias("n")).where("n > 1").select("g", "whole", F.lit(True).alias("met"))
        met = cells.join(settle(twice, "met"), ["g", "whole"], "left").withColumn("met", F.coalesce("met", F.lit(False)))
        marked = settle(met, "marked")
        drop_settled(cells)
        done = marked.where("met AND NOT done").select("id", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + WINDOW).alias("end"))
        found = done if found is None else found.union(done)
        if width > 1:
            alike = marked.groupBy("g", "core").agg(F.sum("m").alias("n"), F.bool_and(F.col("met")).alias("met")).where("n > 1 AND NOT met").select("g", "core")
            rest = marked.join(alike, ["g", "core"], "left_semi")
            rows = rest.select("g", "id", "at", "m", "lo", "hi", "left", "right", (F.col("done") | F.col("met")).alias("done"))
    return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _joined_spans(rows: DataFrame) -> DataFrame:
    """(id, spans): the maximal runs of each string's (id, start, end), before they are dealt out to its copies."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
            new_id = np.diff(ids, prepend=ids[0] - 1) != 0
            shift = np.cumsum(new_id) * (int(end.max()) + 1)  # runs of one id end before those of the next begin
            reach = np.maximum.accumulate(end + shift)
            new = new_id.copy()
            new[1:] |= start[1:] + shift[1:] > reach[:-1]
            at, firsts = np.flatnonzero(new), np.flatnonzero(new_id)
            last = np.append(at[1:], len(ids)) - 1
            runs = pa.StructArray.from_arrays([pa.array(start[at]), pa.array((reach - shift)[last])], names=["start", "end"])
            offsets = np.searchsorted(at, np.append(firsts, len(ids))).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(ids[firsts]), pa.ListArray.from_arrays(pa.array(offsets), runs)], names=["id", "spans"])

        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            # the last id may go on in the next batch
            held = [np.concatenate((old, batch.column(c).to_numpy())) for old, c in zip(held, ("id", "start", "end"), strict=True)]
            cut = np.searchsorted(held[0], held[0][-1]) if len(held[0]) else 0
            if cut:
                yield joined(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield joined(*held)

    dealt = rows.repartition("id").sortWithinPartitions("id", "start")
    return dealt.mapInArrow(work, "id long, spans array<struct<start:long,end:long>>")


def dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, spans, kept_sha256`` for every row of ``docs``, and the ``kept`` bytes if asked.

    ``spans`` are the maximal removed runs (start, end exclusive) in the text's UTF-8 bytes. A null text counts as
    empty; texts shorter than a window lose nothing. Windows never reach from one document into another, and what
    repeats is judged on the input. Each row is a document, whatever its id: rows that repeat an id and text are
    copies of each other. Rows are named by id and a hash of id and text, so those without an id, or with the same
    one, are told apart by their texts.
    """
    named = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc"), "text")
    given = named.withColumn("key", F.xxhash64("doc", "text"))
    own = given.select("doc", "key", "text")
    found = settle(_found_segments(own), "segments")
    anchors = found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    anchors = settle(anchors, "anchors")
    with bloom_joins(docs.sparkSession):
        shared = found.join(selective(anchors, "anchor"), "anchor", "left_semi").drop("anchor")
        shared = settle(shared, "shared-segments")
    drop_settled(found, anchors)
    classes = shared.groupBy("content").agg(F.count("*").alias("m"), F.min(F.struct("doc", "key", "lo", "hi", "at")).alias("r"))
    classes = settle(classes.select(F.monotonically_increasing_id().alias("id"), "content", "m", "r.*"), "classes")
    strings = _strings(own, classes)
    ranks = suffix_ranks(strings.select("id", "chars"), DEPTH)
    sides = settle(_sides(_groups(strings, ranks), strings), "sides")
    repeated = _joined_spans(_repeated(sides).select("id", "start", "end"))
    repeated = settle(classes.select("id", "content").join(repeated, "id").select("content", "spans"), "repeated")
    drop_settled(strings, sides)
    placed = shared.select("doc", "key", "lo", "content").join(repeated, "content")
    moved = F.transform("spans", lambda s: F.struct((s["start"] + F.col("lo")).alias("start"), (s["end"] + F.col("lo")).alias("end")))
    # equal rows give equal hits, which are one
    hits = placed.select("doc", "key", moved.alias("hit")).groupBy("doc", "key").agg(F.collect_set("hit").alias("hits"))
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH):
            sizes, spans, digests, kept = [], [], [], []
            for data, hits_ in zip(_texts(batch), batch.column("hits").to_pylist(), strict=True):
                merged = _merged([(s["start"], s["end"]) for h in hits_ or () for s in h])
                cuts = [0, *(x for s in merged for x in s), len(data)]
                rest = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                sizes.append(len(data))
                spans.append([{"start": a, "end": b} for a, b in merged])
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            out = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(digests, pa.string())]
            names = ["doc_id", "n_bytes", "spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([*out, *([pa.array(kept, pa.binary())] if with_text else [])], names=names + ["kept"] * with_text)

    schema = f"doc_id {doc_type}, n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string" + ", kept binary" * with_text
    return given.join(hits, ["doc", "key"], "left").select("doc_id", "text", "hits").mapInArrow(work, schema)
