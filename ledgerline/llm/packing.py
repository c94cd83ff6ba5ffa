"""Best-fit packing of tokenised documents into sequences of bounded length.

Documents are cut into pieces only where they are longer than a sequence. Which piece goes where depends on the
piece lengths alone, and there are at most ``capacity`` different ones. So the plan is made on the histogram of
lengths, whole classes of equal bins at a time, and its size is bounded by the capacity, however many documents
there are:

1. Large-item matching: no bin holds more than two pieces above a third of the capacity. From the longest down,
   each is paired greedily with the longest other large piece that still fits.
2. Best fit: smaller pieces, longest first, go to the bin with the smallest gap that holds them.

Pieces then get their place by their rank among the pieces of the same length, which is counted in salted groups.
"""

from __future__ import annotations

import array
import bisect
import functools
import json
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.llm.common import arrow_rows, settle

CAPACITY = 4096
END_ID = 1
BATCH = 512
#: Pieces of one length that are ranked together.
GROUP = 1000
_CACHED = 150_000

# The shape of tokenizer files whose tokens never span white space, which allows to encode and
# remember each blank-separated word by itself.
_BY_WORD_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_BY_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Beyond these characters, lower-casing, normal forms or blanks may differ between libraries: encode as a whole.
_UNUSUAL = re.compile("[^\t-\r -~\x85\xa0-ȷ]|<\\|")
#: The same pattern for words of the remaining characters: all from À on but two are letters.
_LETTERS, _NUMBERS = "a-zA-ZªµºÀ-ÖØ-öø-ȷ", "0-9²³¹¼½¾"
_TOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write each byte as a visible character: itself, or one from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 256 + i for i, b in enumerate(hidden)}


class _Tokens(dict):
    """Ids of each token as bytes; filled by the tokenizer's own merges as tokens are met."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model, self.letters = tokenizer.model, _byte_letters()

    def __missing__(self, token: str) -> bytes:
        text = token if token.isascii() else token.encode().decode("latin-1").translate(self.letters)
        self[token] = found = array.array("I", [x.id for x in self.model.tokenize(text)]).tobytes()
        return found


class _Words(dict):
    """Ids of each blank-separated word."""

    def __init__(self, tokens: _Tokens):
        super().__init__()
        self.tokens = tokens

    def __missing__(self, word: str) -> bytes:
        self[word] = found = b"".join([self.tokens[t] for t in _TOKENS.findall(word)])
        return found


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        normalizer = (spec.get("normalizer") or {}).get("normalizers", [])
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (
            [x.get("type") for x in normalizer] == _BY_WORD_NORMALIZER
            and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
            and (steps[0].get("pattern") or {}).get("Regex") == _BY_WORD_PATTERN
            and not steps[1].get("add_prefix_space")
            and sys.byteorder == "little"
        )
        self.words = _Words(_Tokens(self.tokenizer))

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        odd = [i for i, t in enumerate(texts) if not self.by_word or _UNUSUAL.search(t)]
        for i, ids in zip(odd, self._whole([texts[i] for i in odd]), strict=True):
            out[i] = ids
        if len(self.words) > _CACHED:
            self.words.clear()
        if len(self.words.tokens) > _CACHED:
            self.words.tokens.clear()
        find, skipped = self.words.__getitem__, set(odd)
        for i, text in enumerate(texts):
            if i not in skipped:
                out[i] = b"".join(map(find, text.lower().split()))
        return out


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def tokenise(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: ``doc_id, piece, start, length, ids_crc32`` and, if asked, ``ids`` (array<int>).

    A document is its token ids and the end id; a null text counts as empty and so has the end id alone. Pieces
    hold ``capacity`` ids, the last one of a document what is left. Rows with the same id are separate documents.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in arrow_rows(batches, BATCH):
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            encoded = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            for row, found in enumerate(encoded):
                whole = found + end
                for at in range(0, len(whole), 4 * capacity):
                    cut = whole[at : at + 4 * capacity]
                    owner.append(row)
                    piece.append(at // (4 * capacity))
                    start.append(at // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
                    if with_ids:
                        ids.append(np.frombuffer(cut, dtype="<u4").astype(np.int32))
            columns = [batch.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {doc_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(work, schema)


class Plan:
    """Bins by class: ``add`` files a class of equal bins under its gap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_gap: dict[int, list[tuple[int, tuple]]] = {}
        self.gaps: list[int] = []

    def add(self, gap: int, bins: int, pattern: tuple) -> None:
        if bins:
            if gap not in self.by_gap:
                self.by_gap[gap] = []
                bisect.insort(self.gaps, gap)
            self.by_gap[gap].append((bins, pattern))

    def take(self, least: int) -> tuple[int, int | None, tuple]:
        """A class with the smallest gap that is large enough, or any number of empty bins."""
        at = bisect.bisect_left(self.gaps, least)
        if at == len(self.gaps):
            return self.capacity, None, ()
        gap = self.gaps[at]
        bins, pattern = self.by_gap[gap].pop()
        if not self.by_gap[gap]:
            del self.by_gap[gap], self.gaps[at]
        return gap, bins, pattern

    def classes(self) -> list[tuple[int, tuple]]:
        return [found for gap in self.gaps for found in self.by_gap[gap]]


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple]]:
    """Classes ``(bins, ((length, pieces of it in each bin), ...))`` that hold ``counts`` pieces of each length."""
    plan = Plan(capacity)
    left = {n: c for n, c in counts.items() if c}
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        x = large[-1]
        at = bisect.bisect_right(large, capacity - x) - 1
        if at >= 0 and large[at] == x and left[x] == 1:
            at -= 1
        if at < 0:
            plan.add(capacity - x, left.pop(x), ((x, 1),))
            large.pop()
            continue
        y = large[at]
        pairs = left[x] // 2 if x == y else min(left[x], left[y])
        plan.add(capacity - x - y, pairs, ((x, 2),) if x == y else ((x, 1), (y, 1)))
        for n in (y, x):
            left[n] -= pairs
        for n in {x, y}:
            if not left[n]:
                del left[n]
                large.remove(n)
    for n in sorted(left, reverse=True):
        todo = left[n]
        while todo:
            gap, bins, pattern = plan.take(n)
            each = gap // n
            full = todo // each if bins is None else min(bins, todo // each)
            plan.add(gap - each * n, full, (*pattern, (n, each)))
            todo -= full * each
            spare = None if bins is None else bins - full
            if todo and todo < each and spare != 0:
                plan.add(gap - todo * n, 1, (*pattern, (n, todo)))
                todo, spare = 0, None if spare is None else spare - 1
            if spare:
                plan.add(gap, spare, pattern)
    return plan.classes()


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, so that no sequence is longer than ``capacity``.

    ``pieces`` needs doc_id, piece, start, length (1 to ``capacity``) and ids_crc32; it is written to the shared
    folder first, as it is read three times. Equal rows are interchangeable. An empty table gives an empty result.
    """
    pieces = settle(pieces, "pieces")
    per_length = pieces.groupBy("length").count()
    counts = {row["length"]: row["count"] for row in per_length.collect()}  # at most ``capacity`` rows
    table, used, first = [], dict.fromkeys(counts, 0), 0
    for bins, pattern in plan_bins(counts, capacity):
        offset = 0
        for n, each in pattern:
            table.append((n, used[n], each, first, offset))
            used[n] += bins * each
            offset += each * n
        first += bins
    lengths, ranks, eachs, firsts, offsets = (np.array(x, dtype=np.int64) for x in zip(*sorted(table), strict=True)) if table else [np.zeros(0, np.int64)] * 5
    keys = (lengths << 44) + ranks

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (n << 44) + rank, side="right") - 1
            within = rank - ranks[at]
            out = batch.drop_columns(["rank"])
            out = out.append_column("sequence_id", pa.array(firsts[at] + within // eachs[at], pa.int64()))
            yield out.append_column("offset", pa.array(offsets[at] + within % eachs[at] * n, pa.int64()))

    salts = per_length.select("length", (F.floor(F.col("count") / GROUP) + 1).alias("salts"))
    salted = pieces.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "salts"))
    sums = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = settle(before.select("length", "salt", F.coalesce(F.sum("n").over(sums), F.lit(0)).alias("before")), "ranks")
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("own", F.row_number().over(own)).join(before, ["length", "salt"])
    ready = ranked.select(*pieces.columns, (F.col("before") + F.col("own") - 1).cast("long").alias("rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ready.mapInArrow(work, f"{schema}, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` from placed pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
