"""Alignment of two tokenizers over a corpus: which tokens of A and B cover the same bytes, and how often.

A token ids and B token ids of a text are cut into groups at the byte offsets where tokens of both end; tokens of a
group are linked. The identity map gives the B token of the same bytes for each A token. Pairs of that map are counted
in a vector as long as A's vocabulary, kept by each task; only the other, irregular pairs are shuffled and counted.

A text is a sequence of units, words with the blank before them, that neither tokenizer reaches across. Every unit is
encoded and aligned once for a chunk of documents, all units of a chunk at once in arrays. A chunk keeps its documents
as unit numbers, its units as lists of pair numbers and its distinct pairs. To give each document the corpus-wide
counts of its pairs, a chunk asks once for each of its distinct pairs: what is shuffled grows with the different pairs
of a chunk, not with occurrences. A chunk ends when it holds enough units, so its size is bounded by one document more.

Where a tokenizer's file does not have the properties that units rely on, a whole text is one unit.

Rows: null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens: zeros and an
empty hash. Rows that repeat an id or have none are documents of their own, counted and returned each. Further columns
are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import arrow_rows, settle
from ledgerline.session import with_settings

#: A chunk of documents ends with the document in which it reaches so many distinct units, or units in all.
UNITS = 1 << 16
OCCURRENCES = 1 << 19
#: Chunks that one Arrow batch holds.
CHUNKS = 4
#: Documents that are taken from an Arrow batch at once.
BATCH = 512

# The split of byte-level vocabularies, which never joins a blank to what stands before it.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A unit begins at a single blank or line end between other characters.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_BLANK = "▁"


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a visible character: itself, or one from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocabulary = _byte_letters(), spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.bytes = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        split = spec.get("pre_tokenizer") or {}
        self.by_unit = not spec.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex") is True and not split.get("add_prefix_space")
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        first = len(vocabulary) - len(special.keys() & vocabulary.keys()) - len(merges)
        if self.by_unit and all(vocabulary.get(x + y) == first + i for i, (x, y) in enumerate(merges)):
            import tiktoken

            ranks = {b: i for i, b in enumerate(self.bytes) if i < first + len(merges)}
            self._encode = tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True
            self._encode = lambda text: whole.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encode(t) for t in texts]


class Pieces:
    """A sentencepiece model, which puts a blank before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            spec = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in enumerate(pieces)
        ]
        normal = spec.normalizer_spec
        self.by_unit = (
            spec.trainer_spec.model_type == spec.trainer_spec.BPE
            and not normal.precompiled_charsmap
            and normal.add_dummy_prefix
            and not normal.remove_extra_whitespaces
            and not any("\n" in p or _BLANK in p.lstrip(_BLANK) for p in pieces)
        )

    def encode(self, units: list[str]) -> list[list[int]]:
        """Ids of units that begin with a blank, which the model adds itself, or with a line end, which it adds one to."""
        found = self.model.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return [ids if u[0] == " " else ids[1:] for u, ids in zip(units, found, strict=True)]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.by_unit = self.a.by_unit and self.b.by_unit
        self.lengths = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        same = {x: i for i, x in reversed(list(enumerate(self.b.bytes))) if self.b.model.is_byte(i)}
        same |= {x: i for i, x in enumerate(self.b.bytes) if not (self.b.model.is_byte(i) or self.b.model.is_control(i) or self.b.model.is_unknown(i))}
        #: The B id of the same bytes for each A id, or -1.
        self.identity = np.array([same.get(x, -1) for x in self.a.bytes], np.int64)
        most = max(len(self.a.bytes), len(self.b.bytes))
        self.written = np.array([[f"{i}{mark}" for i in range(most)] for mark in ",|;"], dtype=object)

    def units(self, text: str) -> list[str]:
        return _CUT.split(" " + text) if self.by_unit else [" " + text]

    def align(self, units: list[str]) -> Aligned:
        return Aligned(self, units)


class Aligned:
    """Units and what their alignment holds: tokens, groups, links, written groups, and pairs by their numbers."""

    def __init__(self, by: Aligner, units: list[str]):
        encoded = [side.encode(units) for side in (by.a, by.b)]
        raw = [u.encode() for u in units]
        self.good = np.ones(len(units), bool)
        for side, found in zip((by.a, by.b), encoded, strict=True):
            piece = side.bytes.__getitem__
            self.good &= np.array([b"".join(map(piece, ids)) == x for ids, x in zip(found, raw, strict=True)], bool)
        for found in encoded:
            for i in np.flatnonzero(~self.good).tolist():
                found[i] = []
        sizes = [np.array([len(ids) for ids in found], np.int64) for found in encoded]
        ids = [np.fromiter(itertools.chain.from_iterable(found), np.int64, n.sum()) for found, n in zip(encoded, sizes, strict=True)]
        del encoded, raw
        ends = [np.cumsum(lengths[i]) for lengths, i in zip(by.lengths, ids, strict=True)]
        cuts = np.intersect1d(*ends, assume_unique=True)  # ends of units are ends on both sides
        groups = [np.searchsorted(cuts, end) for end in ends]
        held = [np.bincount(g, minlength=len(cuts)) for g in groups]
        unit = [np.repeat(np.arange(len(units)), n) for n in sizes]
        of_group = np.zeros(len(cuts), np.int64)
        of_group[groups[0]] = unit[0]
        self.n_a, self.n_b = sizes
        self.n_groups = np.bincount(of_group, minlength=len(units))
        self.n_links = np.zeros(len(units), np.int64)
        np.add.at(self.n_links, of_group, held[0] * held[1])
        self.written = self._write(by, ids, groups, held, sizes)
        self._pairs(by, ids, groups, of_group, len(cuts), len(units))

    def _write(self, by, ids, groups, held, sizes) -> list[str]:
        """``a1,a2|b1;`` for the groups of each unit."""
        before = [np.cumsum(n) - n for n in held]
        n = [len(i) for i in ids]
        place_a = np.arange(n[0]) + before[1][groups[0]]
        place_b = np.arange(n[1]) + (before[0] + held[0])[groups[1]]
        parts = np.empty(n[0] + n[1], dtype=object)
        for side, place in ((0, place_a), (1, place_b)):
            last = np.ones(n[side], bool)
            last[:-1] = groups[side][1:] != groups[side][:-1]
            parts[place] = by.written[np.where(last, side + 1, 0), ids[side]]
        parts, stops = parts.tolist(), np.cumsum(sizes[0] + sizes[1]).tolist()
        return ["".join(parts[low:high]) for low, high in zip([0, *stops], stops, strict=False)]

    def _pairs(self, by, ids, groups, of_group, n_groups, n_units) -> None:
        """The distinct pairs of all units; each unit's as numbers with their links, one after the other."""
        width = len(by.b.bytes)
        sides = []
        for i, group, span in zip(ids, groups, (len(by.a.bytes), width), strict=True):
            keys, links = np.unique(group * span + i, return_counts=True)
            sides.append((keys % span, links, np.bincount(keys // span, minlength=n_groups), keys // span))
        (a, a_links, _, a_group), (b, b_links, b_held, _) = sides
        reach = b_held[a_group]
        left = np.repeat(np.arange(len(a)), reach)
        first = (np.cumsum(b_held) - b_held)[a_group]
        right = np.arange(len(left)) + np.repeat(first - (np.cumsum(reach) - reach), reach)
        pairs = a[left] * width + b[right]
        self.pairs, number = np.unique(pairs, return_inverse=True)
        self.links = a_links[left] * b_links[right]
        self.pair_of = number
        self.ends = np.cumsum(np.bincount(of_group[a_group[left]], minlength=n_units))


@functools.lru_cache(maxsize=2)
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<u4").tobytes())


def _unpacked(stored: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(stored), "<u4").astype(np.int64)


def _gathered(ends: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Places of all entries of the units, one unit after the other."""
    held = np.diff(ends, prepend=0)[units]
    return np.arange(held.sum()) + np.repeat(ends[units] - np.cumsum(held), held)


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


class _Chunk:
    """Documents as unit numbers until they are enough."""

    def __init__(self):
        self.units: dict[str, int] = {}
        self.docs: list[np.ndarray] = []
        self.size = 0

    def add(self, units: list[str]) -> None:
        number = self.units.setdefault
        self.docs.append(np.array([number(u, len(self.units)) for u in units], np.int64))
        self.size += len(units)

    def full(self) -> bool:
        return len(self.units) >= UNITS or self.size >= OCCURRENCES

    def close(self, by: Aligner, vector: np.ndarray) -> dict:
        """The chunk as a row; pairs of the identity map are counted in ``vector``, once for each document."""
        found, width = by.align(list(self.units)), len(by.b.bytes)
        regular = by.identity[found.pairs // width] == found.pairs % width
        order = np.argsort(regular, kind="stable")  # irregular pairs get the first numbers
        renumbered = np.empty(len(order), np.int64)
        renumbered[order] = np.arange(len(order))
        pair_of, irregular = renumbered[found.pair_of], int((~regular).sum())
        held, stamp = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        digests, numbers, kept = [], {n: [] for n in _NUMBERS}, []
        for units in self.docs:
            if not found.good[units].all():
                units = units[:0]
            kept.append(units)
            text = "".join([found.written[u] for u in units.tolist()])
            digests.append(hashlib.sha256(text[:-1].encode()).hexdigest() if text else "")
            for n in _NUMBERS:
                numbers[n].append(int(getattr(found, n)[units].sum()))
            pairs = pair_of[_gathered(found.ends, units)]
            turn = np.arange(len(pairs))
            stamp[pairs] = turn
            held[pairs[stamp[pairs] == turn]] += 1
        pairs = found.pairs[order]
        vector[pairs[irregular:] // width] += held[irregular:]
        return numbers | {
            "groups_sha256": digests,
            "sizes": _packed(np.array([len(u) for u in kept])),
            "units": _packed(np.concatenate(kept)),
            "unit_ends": _packed(found.ends),
            "unit_pairs": _packed(pair_of),
            "unit_links": _packed(found.links),
            "irregular": pairs[:irregular],
            "held": held[:irregular],
            "regular": _packed(pairs[irregular:] // width),
        }


def _chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row for each chunk of documents, and one for each task (without a chunk number) with its vector of counts."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    binaries = ["sizes", "units", "unit_ends", "unit_pairs", "unit_links", "regular"]
    schema = f"chunk long, doc_id array<{doc_type}>, " + "".join(f"{n} array<long>, " for n in _NUMBERS)
    schema += "groups_sha256 array<string>, irregular array<long>, held array<long>, " + ", ".join(f"{n} binary" for n in binaries)
    kinds = {n: pa.list_(pa.int64()) for n in [*_NUMBERS, "irregular", "held"]} | dict.fromkeys(binaries, pa.binary())
    kinds |= {"chunk": pa.int64(), "groups_sha256": pa.list_(pa.string())}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        by, number = _aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        vector, chunk, ids = np.zeros(len(by.a.bytes), np.int64), _Chunk(), []
        id_type = None

        def row(values: dict, owners) -> pa.RecordBatch:
            names = ["chunk", "doc_id", *_NUMBERS, "groups_sha256", "irregular", "held", *binaries]
            kind = kinds | {"doc_id": pa.list_(id_type)}
            return pa.RecordBatch.from_arrays([pa.array([values.get(n) if n != "doc_id" else owners], kind[n]) for n in names], names=names)

        for batch in arrow_rows(batches, BATCH):
            id_type = batch.column("doc_id").type
            for own, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                chunk.add(by.units(text) if text else [])
                ids.append(own)
                if chunk.full():
                    yield row(chunk.close(by, vector) | {"chunk": number}, ids)
                    number, chunk, ids = number + 1, _Chunk(), []
        if ids:
            yield row(chunk.close(by, vector) | {"chunk": number}, ids)
        if id_type is not None:
            met = np.flatnonzero(vector)
            yield row({"irregular": met, "held": vector[met]}, [])

    return docs.select("doc_id", "text").mapInArrow(work, schema)


def _per_a(rows: DataFrame, size: int) -> np.ndarray:
    """``(a, n)`` as a vector; at most one row for each token of A's vocabulary."""
    out = np.zeros(size, np.int64)
    for row in rows.collect():
        out[row.a] = row.n
    return out


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    spark, by = docs.sparkSession, _aligner(a_path, b_path)
    doc_type, width = docs.schema["doc_id"].dataType.simpleString(), len(by.b.bytes)
    stored = settle(_chunks(docs, a_path, b_path), "aligned-chunks")
    each = F.explode(F.arrays_zip("irregular", "held")).alias("x")
    counted = stored.select("chunk", each).select("chunk", F.col("x.irregular").alias("pair"), F.col("x.held").alias("held"))
    regular = counted.where("chunk IS NULL").groupBy(F.col("pair").alias("a")).agg(F.sum("held").alias("n"))
    identity = _per_a(regular, len(by.a.bytes))
    pairs = settle(counted.where("chunk IS NOT NULL").groupBy("pair").agg(F.sum("held").alias("n")), "pair-counts")
    first = F.floor(F.col("pair") / width).cast("long").alias("a")
    best = np.maximum(identity, _per_a(pairs.groupBy(first).agg(F.max("n").alias("n")), len(by.a.bytes)))
    chunks = stored.where("chunk IS NOT NULL")
    asked = chunks.select("chunk", F.posexplode("irregular").alias("place", "pair")).join(pairs, "pair")
    answers = asked.groupBy("chunk").agg(F.collect_list("place").alias("places"), F.collect_list("n").alias("counts"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                a = np.concatenate([row["irregular"].values.to_numpy() // width, _unpacked(row["regular"].as_py())])
                count = identity[a]
                if row["places"].values is not None:
                    count[row["places"].values.to_numpy()] = row["counts"].values.to_numpy()
                links, pair_of = _unpacked(row["unit_links"].as_py()), _unpacked(row["unit_pairs"].as_py())
                ends, units = _unpacked(row["unit_ends"].as_py()), _unpacked(row["units"].as_py())
                stops = np.cumsum(_unpacked(row["sizes"].as_py()))
                sums = []
                for value in (links * (count == best[a])[pair_of], links * count[pair_of]):
                    upto = np.concatenate([[0], np.cumsum(value)])[ends]
                    of_unit = np.diff(upto, prepend=0)[units]
                    sums.append(np.diff(np.concatenate([[0], np.cumsum(of_unit)])[stops], prepend=0))
                columns = [row["doc_id"].values, *(row[n].values for n in _NUMBERS), *map(pa.array, sums), row["groups_sha256"].values]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"])

    schema = f"doc_id {doc_type}, " + "".join(f"{n} long, " for n in [*_NUMBERS, "n_best", "count_sum"]) + "groups_sha256 string"
    with with_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(CHUNKS)}):
        return settle(chunks.drop("held").join(answers, "chunk", "left").mapInArrow(work, schema), "aligned")
