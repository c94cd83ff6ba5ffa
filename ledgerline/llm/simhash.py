"""SimHash near-duplicates by tiled exact comparison.

Rows with equal fingerprints are one class, so copies never meet. The distinct fingerprints are laid out in tiles of
bounded size, and tiles are compared whole: exclusive-or and bit counts over two integer arrays. A pair of tiles is
skipped where population counts alone rule out every pair in it. To skip more, a fingerprint counts its bits in each
of several equal parts: the differences of those counts, summed over the parts, never exceed the number of differing
bits. The parts grow with the number of fingerprints (1, 2, 4, 8 or 16), so that a tile meets a small share of the
others however many there are; every pair within the radius is compared at any number of parts.

A pair of tiles gives a forest of its links (each linked fingerprint with the smallest one it reaches there), not all
of them, so a dense group of fingerprints yields a bounded number of edges and loses no connection.

Rows: a null text is an empty one. A text without words has fingerprint zero and links like any other. A null id has a
fingerprint and a component like any row but is never the smallest id; a component of null ids only has a null id.
Rows that repeat an id are rows of their own and all returned. Further columns of the input are not looked at.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import arrow_rows, components, settle

WORDS = 3
SEED = 42
RADIUS = 2
BITS = 64
#: Rows of a tile, and least rows that a tile of a further division must have on average.
TILE = 512
LEAST = 64
BATCH = 512
_HASHES = 1 << 16


def fingerprint(text: bytes | None) -> bytes:
    """Eight bytes, the first bit first: a bit is 1 if more than half of the shingles' hashes have it."""
    words = (text or b"").lower().split()
    if not words:
        return bytes(BITS // 8)
    if len(words) < WORDS:
        return xxhash.xxh64_digest(b" ".join(words), SEED)
    shingles, digest = zip(*(words[i:] for i in range(WORDS))), xxhash.xxh64_digest
    ones, total = np.zeros(BITS, np.int64), 0
    while block := b"".join([digest(b" ".join(s), SEED) for s in itertools.islice(shingles, _HASHES)]):
        hashes = np.frombuffer(block, np.uint8).reshape(-1, BITS // 8)
        ones += np.add.reduce(np.unpackbits(hashes, axis=1), axis=0, dtype=np.int64)
        total += len(hashes)
    return np.packbits(2 * ones > total).tobytes()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (the 64 bits as a long) of every row."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH):
            texts = batch.column("text").cast(pa.binary() if pa.types.is_string(batch.column("text").type) else pa.large_binary())
            prints = np.frombuffer(b"".join([fingerprint(t.as_py()) for t in texts]), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {doc_type}, fingerprint long")


def parts_for(rows: int) -> int:
    """As many parts as leave tiles ``LEAST`` rows on average, were the bits of ``rows`` fingerprints random."""
    parts = 1
    while parts < 16 and rows >= LEAST * math.sqrt(math.pi * BITS / (2 * parts)) ** (2 * parts):
        parts *= 2
    return parts


def steps(parts: int, radius: int) -> list[int]:
    """Differences of two tile keys, packed like them, that add up to the radius at most; of each two opposite ones the larger."""
    width, found = _width(parts), {0}
    units = [sign << (width * i) if sign > 0 else -(1 << (width * i)) for i in range(parts) for sign in (1, -1)]
    for _ in range(radius):
        found |= {f + u for f in found for u in units}
    return sorted(f for f in found if f >= 0)


def _width(parts: int) -> int:
    return (BITS // parts).bit_length()


def tile_key(bits: Column, parts: int) -> Column:
    """The population counts of the parts, side by side in one long."""
    size, width = BITS // parts, _width(parts)
    key = F.lit(0).cast("long")
    for i in range(parts):
        part = F.shiftrightunsigned(bits, i * size)
        part = part if parts == 1 else part.bitwiseAND(F.lit((1 << size) - 1))
        key = key + F.shiftleft(F.bit_count(part).cast("long"), i * width)
    return key


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint of two tiles that links to another, with the smallest one it reaches within them."""
    i, j = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius)
    apart = left[i] != right[j]
    nodes, ends = np.unique(np.concatenate([left[i[apart]], right[j[apart]]]), return_inverse=True)
    a, b = ends.reshape(2, -1)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


def _compare(radius: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                low, high = forest(left.values.to_numpy(), right.values.to_numpy(), radius)
                lows.append(low)
                highs.append(high)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lows)), pa.array(np.concatenate(highs))], names=["a", "b"])

    return work


def links(distinct: DataFrame, rows: int, radius: int = RADIUS) -> DataFrame:
    """Edges ``(a, b)`` that connect what links of ``distinct(fingerprint)`` connect; ``rows`` is their number."""
    parts = parts_for(rows)
    keyed = distinct.select("fingerprint", tile_key(F.col("fingerprint"), parts).alias("key"))
    sizes = settle(keyed.groupBy("key").agg(F.ceil(F.count("*") / TILE).alias("cuts")), "tile-sizes")
    cut = F.pmod(F.xxhash64("fingerprint"), F.col("cuts")).alias("cut")
    placed = keyed.join(sizes, "key").select("key", cut, "fingerprint")
    tiles = settle(placed.groupBy("key", "cut").agg(F.collect_list("fingerprint").alias("rows")), "tiles")
    near = F.explode(F.transform(F.array(*map(F.lit, steps(parts, radius))), lambda d: F.col("key") + d))
    left = tiles.select(near.alias("key"), F.col("key").alias("own"), F.col("cut").alias("own_cut"), F.col("rows").alias("left"))
    pairs = left.join(tiles.withColumnRenamed("rows", "right"), "key").where("own < key OR own_cut <= cut")
    return pairs.select("left", "right").mapInArrow(_compare(radius), "a long, b long")


def near_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the smallest id reachable by links, its own included."""
    marked = settle(fingerprints(docs), "fingerprints")
    classes = settle(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "print-classes")
    edges = settle(links(classes.select("fingerprint"), classes.count(), radius).distinct(), "print-links")
    roots = components(edges).withColumnRenamed("node", "fingerprint")
    rooted = classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = settle(rooted.join(least, "root").select("fingerprint", "component_id"), "print-components")
    digits = F.lower(F.lpad(F.hex("fingerprint"), BITS // 4, "0")).alias("fingerprint")
    return marked.join(found, "fingerprint").select("doc_id", digits, "component_id")
