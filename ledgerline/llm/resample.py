"""Target-distribution importance resampling on hashed n-grams.

A document's features are its runs of one to three words, each counted in a bucket by its hash. Buckets are counted
over all documents and over the target texts; a bucket's gain is the logarithm of how much likelier the target is to
use it, and a document's weight the sum of the gains of its features. Adding Gumbel noise made from the id and taking
the highest scores draws documents without replacement in proportion to their weights, the same ones in every run.

Runs of words repeat a lot, so each batch interns them: an open-addressed NumPy table, keyed by xxhash64, holds every
run once with its bucket and its count. Equal keys are verified byte by byte; unequal bytes go on to the next slot.
The slot ids of the occurrences then gather the gains. Two passes over the texts (counts, weights) keep nothing of a
document but its numbers; only the counts of the buckets, whose number is a parameter, come to the driver.

Ranks: rows are collapsed and counted, dealt into ranges of scores, and placed by the rows before them, so that no
task holds more than its range and copies of a row cost nothing.

Rows: a null text has no words, no features and weight 0; a null id counts as the empty text in the noise and comes
last among equal scores. Rows that repeat an id are documents of their own; of such with equal scores any may come
first. Empty tables draw nothing, an empty target gives gains that only the documents shape. Further columns are not
looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.common import settle
from ledgerline.operators.copies import restore_copies

LONGEST_RUN = 3
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of text and number of words that are worked on at once.
BATCH_BYTES = 1 << 22
SEGMENT = 1 << 16

#: Spans of one length below which they are hashed one by one.
_FEW = 64

# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)
#: The step of CRC-32 for each byte.
_CRC = np.array([~zlib.crc32(bytes([b]), 0xFFFFFFFF) & 0xFFFFFFFF for b in range(256)], np.uint32)

#: Bytes of words (digits, letters in lower case, all of other scripts) as they are; a blank for any other.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def _mixed(x: np.ndarray) -> np.ndarray:
    return _rotated(x * _P2, 31) * _P1


class Bytes:
    """Hashes of many spans of one byte string, worked out for all spans of a length at once."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.byte = np.frombuffer(raw + bytes(8), np.uint8)
        self.long = np.ndarray(len(raw) + 1, "<u8", self.byte, strides=(1,))
        self.int = np.ndarray(len(raw) + 1, "<u4", self.byte, strides=(1,))

    def by_length(self, start: np.ndarray, length: np.ndarray, dtype: type, vector, single) -> np.ndarray:
        """``vector(starts, length)`` for each length that many spans have, ``single(bytes)`` for spans of the others."""
        out = np.empty(len(start), dtype)
        small = length.max(initial=0) < 1 << 16  # numbers of 16 bits are sorted by digits
        order = np.argsort(length.astype(np.uint16) if small else length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for rows in np.split(order, cuts):
            if len(rows) >= _FEW:
                out[rows] = vector(start[rows], int(length[rows[0]]))
            else:
                spans = zip(start[rows].tolist(), (start[rows] + length[rows]).tolist(), strict=True)
                out[rows] = np.array([single(self.raw[a:b]) for a, b in spans], dtype)
        return out

    def xxhash64(self, start: np.ndarray, length: int) -> np.ndarray:
        """XXH64 with seed 0 of the spans of one length."""
        at, left = start, length
        if length >= 32:
            sums = [np.full(len(start), x % (1 << 64), np.uint64) for x in (int(_P1) + int(_P2), int(_P2), 0, -int(_P1))]
            while left >= 32:
                sums = [_rotated(x + self.long[at + 8 * i] * _P2, 31) * _P1 for i, x in enumerate(sums)]
                at, left = at + 32, left - 32
            found = sum((_rotated(x, r) for x, r in zip(sums, (1, 7, 12, 18), strict=True)), np.uint64(0))
            for x in sums:
                found = (found ^ _mixed(x)) * _P1 + _P4
        else:
            found = np.full(len(start), _P5)
        found += np.uint64(length)
        while left >= 8:
            found = _rotated(found ^ _mixed(self.long[at]), 27) * _P1 + _P4
            at, left = at + 8, left - 8
        if left >= 4:
            found = _rotated(found ^ self.int[at].astype(np.uint64) * _P1, 23) * _P2 + _P3
            at, left = at + 4, left - 4
        for i in range(left):
            found = _rotated(found ^ self.byte[at + i].astype(np.uint64) * _P5, 11) * _P1
        found = (found ^ found >> np.uint64(33)) * _P2
        found = (found ^ found >> np.uint64(29)) * _P3
        return found ^ found >> np.uint64(32)

    def crc32(self, start: np.ndarray, length: int) -> np.ndarray:
        found = np.full(len(start), 0xFFFFFFFF, np.uint32)
        for i in range(length):
            found = _CRC[(found ^ self.byte[start + i]) & np.uint32(255)] ^ found >> np.uint32(8)
        return ~found

    def equal(self, one: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the bytes of spans of equal lengths are the same."""
        same, i = np.ones(len(one), bool), 0
        rows = np.arange(len(one))
        while len(rows):
            rest = length[rows] - i
            unlike = self.long[one[rows] + i] ^ self.long[other[rows] + i]
            short = rest < 8
            unlike[short] &= (np.uint64(1) << (8 * rest[short]).astype(np.uint64)) - np.uint64(1)
            same[rows[unlike != 0]] = False
            rows, i = rows[(unlike == 0) & (rest > 8)], i + 8
        return same


class Runs:
    """The distinct runs of a segment in an open-addressed table: ``slot`` of each occurrence, ``bucket`` and ``count`` of each slot."""

    def __init__(self, text: Bytes, start: np.ndarray, length: np.ndarray, buckets: int):
        keys = text.by_length(start, length, np.uint64, text.xxhash64, xxhash.xxh64_intdigest)
        size = 1 << max(1, 2 * len(start) - 1).bit_length()
        self.slot, holder = self._intern(text, start, length, keys, size)
        self.count = np.bincount(self.slot, minlength=size)
        used = np.flatnonzero(self.count)
        first = holder[used]
        self.bucket = np.zeros(size, np.int64)
        self.bucket[used] = text.by_length(start[first], length[first], np.int64, text.crc32, zlib.crc32) % buckets

    @staticmethod
    def _intern(text: Bytes, start: np.ndarray, length: np.ndarray, keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each run is kept, the first slot from its key on that is free or holds the same bytes; which run a slot holds."""
        slot = (keys & np.uint64(size - 1)).astype(np.int64)
        holder = np.full(size, -1, np.int64)
        todo = np.arange(len(start))
        while len(todo):
            at = slot[todo]
            free = holder[at] < 0
            holder[at[free]] = todo[free]  # of several that ask for one slot, one gets it
            there = holder[at]
            same = (keys[there] == keys[todo]) & (length[there] == length[todo])
            unsure = np.flatnonzero(same & (there != todo))
            same[unsure] = text.equal(start[there[unsure]], start[todo[unsure]], length[todo[unsure]])
            todo = todo[~same]
            slot[todo] = (slot[todo] + 1) & (size - 1)
        return slot, holder


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Rows in groups of bounded bytes (a longer text is alone), with the words of each."""
    for batch in batches:
        column = batch.column("text")
        texts = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
        start, words, size = 0, [], 0
        for row, text in enumerate(texts):
            raw = text.as_py() or b""
            if words and size + len(raw) > BATCH_BYTES:
                yield batch.slice(start, row - start), words
                start, words, size = row, [], 0
            words.append(raw.translate(_WORD_BYTES).split())
            size += len(raw)
        if words:
            yield batch.slice(start, len(words)), words


def _segments(words: list[list[bytes]], buckets: int) -> Iterator[tuple[np.ndarray, Runs]]:
    """The occurrences of runs in bounded numbers: the document of each, and the table that holds them."""
    flat = [w for own in words for w in own]
    text = Bytes(b" ".join(flat))
    sizes = np.fromiter(map(len, flat), np.int64, len(flat))
    stop = np.cumsum(sizes + 1) - 1
    begin = stop - sizes
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    end = np.repeat(np.cumsum(lengths), lengths)
    for low in range(0, len(flat), SEGMENT):
        here = np.arange(low, min(low + SEGMENT, len(flat)))
        runs = [(here[here + n <= end[here]], n) for n in range(1, LONGEST_RUN + 1)]
        first = np.concatenate([i for i, _ in runs])
        last = np.concatenate([i + n - 1 for i, n in runs])
        yield owner[first], Runs(text, begin[first], stop[last] - begin[first], buckets)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows fall in each bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, words in _batches(batches):
            for _, runs in _segments(words, buckets):
                np.add.at(total, runs.bucket, runs.count)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most one row a bucket
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target over source, each with one more count in every bucket, rounded down."""
    buckets = len(source)
    all_source, all_target = float(source.sum() + buckets), float(target.sum() + buckets)
    ratios = [(float(t) + 1) * all_source / ((float(s) + 1) * all_target) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in _batches(batches):
            features, weight = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            for owner, runs in _segments(words, len(gain)):
                np.add.at(weight, owner, gain[runs.bucket][runs.slot])
                features += np.bincount(owner, minlength=len(words))
            columns = [pa.array([len(w) for w in words], pa.int64()), pa.array(features), pa.array(weight)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {doc_type}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from the id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((draw + 0.5) / 4294967296.0))).cast("long")


def _ranked(rows: DataFrame, copies: str, draws: int) -> DataFrame:
    """Rows that stand for ``copies`` equal ones, each restored and with its ``rank``, or null beyond the draws."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("n_words")]
    ranged = settle(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "score-ranges")
    sizes = sorted((r.part, r.n) for r in ranged.groupBy("part").agg(F.sum(copies).alias("n")).collect())  # one row a range
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = rows.sparkSession.createDataFrame(starts, "part int, before long")
    earlier = F.sum(copies).over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.join(F.broadcast(offsets), "part").withColumn("before", F.col("before") + F.coalesce(earlier, F.lit(0)))
    rank = F.col("before") + F.col("copy")
    return restore_copies(placed, copies, "copy").withColumn("rank", F.when(rank <= draws, rank)).select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``: ``percent`` of the documents of ``least_words`` or more are drawn
    towards the texts of ``target`` and have a rank from 1; all others are returned with none."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    scored = weigh(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    rows = settle(scored.groupBy(*columns).agg(F.count("*").alias("copies")), "scored")
    able = F.col("n_words") >= least_words
    n = rows.where(able).agg(F.sum("copies")).first()[0] or 0
    drawn = _ranked(rows.where(able), "copies", percent * n // 100)
    others = restore_copies(rows.where(~able), "copies", "copy").withColumn("rank", F.lit(None).cast("long"))
    kept = ["doc_id", "n_features", "weight", "score", "rank"]
    return drawn.select(*kept).union(others.select(*kept))
