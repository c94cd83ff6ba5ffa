"""Language-model scoring by a hierarchical Pitman-Yor model.

Each preceding word has a restaurant whose customers are the tokens seen after it; tables serve words. All these context
restaurants share one parent, the word restaurant: every table of theirs is a customer there; its own tables draw
from a uniform base over the known words and one unknown. The start of a text is a context too.

Seating is sampled by Gibbs in blocks: all customers of an entry (a word in a context) leave and sit down again at
once. Only the number of tables matters to a prediction, so that is what is kept. For up to ``SMALL`` customers it is drawn
from its exact distribution; for more it is proposed by seating them in turn in a restaurant of one dish, jumping
from each new table to the next, and accepted by the rule of Metropolis and Hastings. There is a fixed number of passes:
``STARTS`` to leave the first seating, ``BURN_IN``, and ``SAMPLES`` whose predictive probabilities are averaged.

In Spark, the entries lie in buckets of some ``BUCKET_TOKENS`` tokens, by context; the contexts of frequent words are
split over buckets by word. A pass seats the entries of each bucket, and sends the tables of each word to the word's own
bucket (one shuffle), which seats the parent restaurant and sends its numbers back (another). The rows of these
shuffles are packed arrays, one from each bucket to each other that it shares words with, so they are never more
than the words they carry. What the driver sees of a pass are sums, and the totals of split contexts, which are among the
``COMMON`` most frequent words.

Texts are read twice: to count words, and to turn runs of documents (chunks) into numbered pairs of a context and a word.
A chunk's distinct pairs go to the buckets, with their numbers in rows to learn from; pairs of rows that are held
out only are asked for and count nothing. In the end each bucket answers each chunk, and a chunk adds up the answers of its
documents. Rows are scored one by one, whatever their ids, so null and repeated ids and equal rows need no care; a null
text counts as empty and has its end alone. Without rows to learn from no word is known, and any token has the
probability 1, the uniform share of the unknown one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import arrow_rows, drop_settled, settle

COMMON = 1 << 16
STARTS, BURN_IN, SAMPLES = 2, 3, 5
START_SWEEPS = 2
STRENGTH = 1.0
SMALL = 12
BATCH = 256
CHUNK_TOKENS = 1 << 21
BUCKET_TOKENS = 1 << 20
_MESSAGE = "kind string, bucket long, sender string, data binary, code long, v array<double>"
_NAMES = ["kind", "bucket", "sender", "data", "code", "v"]


# Packed arrays


def _narrow(a: np.ndarray) -> np.ndarray:
    """Integers in the smallest signed type that holds them."""
    if a.dtype.kind != "i" or not len(a):
        return a
    low, high = int(a.min()), int(a.max())
    return a.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if low >= np.iinfo(t).min and high <= np.iinfo(t).max), copy=False)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one block; bytes of equal weight lie side by side, so that small numbers take little."""
    stored = [_narrow(a) for a in arrays]
    head = json.dumps([(a.dtype.str, len(a), b.dtype.str) for a, b in zip(arrays, stored, strict=True)]).encode()
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in stored]
    return len(head).to_bytes(4, "little") + head + pa.Codec("zstd", 1).compress(b"".join(planes), asbytes=True)


def _unpack(block: bytes) -> list[np.ndarray]:
    cut = 4 + int.from_bytes(block[:4], "little")
    kinds = [(np.dtype(kind), n, np.dtype(stored)) for kind, n, stored in json.loads(block[4:cut])]
    raw = np.frombuffer(pa.Codec("zstd").decompress(block[cut:], sum(k.itemsize * n for _, n, k in kinds), asbytes=True), np.uint8)
    out, at = [], 0
    for kind, n, stored in kinds:
        size = stored.itemsize * n
        out.append(np.ascontiguousarray(raw[at : at + size].reshape(stored.itemsize, n).T).view(stored).reshape(n).astype(kind, copy=False))
        at += size
    return out


def _steps(sorted_numbers: np.ndarray) -> np.ndarray:
    return np.diff(sorted_numbers, prepend=0).astype(np.int32)


def _messages(rows: list[tuple]) -> pa.Table:
    """Rows of (kind, bucket, sender, data, code, v)."""
    kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.list_(pa.float64())]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=_NAMES)


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Words and pairs


class Vocabulary(dict):
    """Numbers for words as they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def tokens(self, text: bytes | None) -> np.ndarray:
        """The numbers of a text's words, A-Z lower-cased, and of the end, whose word is empty."""
        words = text.lower().split() if text else []
        words.append(b"")
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self), np.uint64, len(self)).view(np.int64)


def count_words(docs: DataFrame) -> DataFrame:
    """(h, n): each word's hash and its tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = Vocabulary(), [], 0

        def counted() -> pa.RecordBatch:
            n = np.bincount(np.concatenate(held), minlength=len(known))
            return pa.RecordBatch.from_arrays([pa.array(known.hashes()), pa.array(n.astype(np.int64))], names=["h", "n"])

        for batch in arrow_rows(batches, BATCH):
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                held.append(known.tokens(text))
                size += len(held[-1])
                if size >= CHUNK_TOKENS:
                    yield counted()
                    known, held, size = Vocabulary(), [], 0
        if held:
            yield counted()

    return docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Words:
    """The common words' hashes (sorted) and over how many buckets each one's context is split; how many buckets; sums."""

    common: np.ndarray
    parts: np.ndarray
    buckets: int
    tokens: int
    words: int

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """A common word's place, a negative hash for any other."""
        at = np.minimum(np.searchsorted(self.common, hashes), max(0, len(self.common) - 1))
        found = self.common[at] == hashes if len(self.common) else np.zeros(len(hashes), bool)
        return np.where(found, at, hashes | np.int64(-(2**63)))

    def parts_of(self, contexts: np.ndarray) -> np.ndarray:
        out = np.ones(len(contexts), np.int64)
        common = contexts >= 0
        out[common] = self.parts[contexts[common]]
        return out

    def home(self, codes: np.ndarray) -> np.ndarray:
        """The bucket of a word."""
        return (_mixed(codes) % np.uint64(self.buckets)).astype(np.int64)

    def bucket(self, contexts: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The bucket of a pair: that of its context, or one of those that a frequent context is split over."""
        part = _mixed(codes ^ np.int64(0x5BD1E995)) % self.parts_of(contexts).astype(np.uint64)
        return ((_mixed(contexts) % np.uint64(self.buckets) + part) % np.uint64(self.buckets)).astype(np.int64)


def _words(docs: DataFrame) -> Words:
    counted = settle(count_words(docs), "lm-words")
    sums = counted.agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).first()
    top = counted.orderBy(F.desc("n"), "h").limit(COMMON).toArrow()
    drop_settled(counted)
    order = np.argsort(np.asarray(top.column("h")))
    n = np.asarray(top.column("n"))[order]
    tokens = sums["tokens"] or 0
    return Words(np.asarray(top.column("h"))[order], n // (BUCKET_TOKENS // 2) + 1, tokens // BUCKET_TOKENS + 1, tokens, sums["words"])


def _pairs(docs: DataFrame, words: Words) -> DataFrame:
    """Rows of chunks (their documents, and each token's place among the chunk's pairs) and of the pairs they send."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"{_MESSAGE}, ids array<{doc_type}>, held array<boolean>"

    def chunk(known: Vocabulary, held: list[np.ndarray], ids: list[pa.Array], flags: list[pa.Array]) -> pa.RecordBatch:
        # what is not needed any more goes before the sort, which takes most memory
        numbers, lengths = np.concatenate(held), np.array([len(x) for x in held])
        held.clear()
        before = np.empty_like(numbers)
        before[1:] = numbers[:-1]
        before[np.cumsum(lengths) - lengths] = known[b""]
        learnt = np.repeat(~np.asarray(pa.concat_arrays(flags).to_numpy(zero_copy_only=False), bool), lengths)
        size, codes = len(known), words.codes(known.hashes())
        known.clear()
        # words are renumbered by code, so that pairs come out sorted
        by_code = np.argsort(codes)
        moved = np.empty(size, np.int32)
        moved[by_code] = np.arange(size, dtype=np.int32)
        tokens = moved[before].astype(np.int64)
        tokens *= size
        tokens += moved[numbers]
        codes = codes[by_code]
        del numbers, before, moved, by_code
        pairs, place = np.unique(tokens, return_inverse=True)
        del tokens
        n = np.bincount(place[learnt], minlength=len(pairs))
        g, h = codes[pairs // size], codes[pairs % size]
        bucket = words.bucket(g, h)
        order = np.argsort(bucket.astype(np.uint16) if words.buckets <= 1 << 16 else bucket, kind="stable")  # 16 bits are sorted by digits
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        name = uuid.uuid4().hex
        rows = [("chunk", 0, name, _pack(lengths.astype(np.int32), rank[place]), None, None)]
        starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for at in np.split(order, starts[1:]):
            rows.append(("pairs", int(bucket[at[0]]), name, _pack(g[at], h[at], n[at].astype(np.int32)), None, None))
        columns = _messages(rows).columns
        kinds = [pa.list_(ids[0].type), pa.list_(pa.bool_())]
        for parts, kind in zip((ids, flags), kinds, strict=True):
            flat = pa.concat_arrays(parts)
            offsets = np.full(len(rows) + 1, len(flat), np.int32)
            offsets[0] = 0
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), flat).cast(kind))
        return pa.Table.from_arrays(columns, names=[*_NAMES, "ids", "held"]).combine_chunks().to_batches()[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, ids, flags, size = Vocabulary({b"": 0}), [], [], [], 0
        for batch in arrow_rows(batches, BATCH):
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                held.append(known.tokens(text))
                ids.append(batch.column("doc_id").slice(i, 1))
                flags.append(batch.column("held_out").slice(i, 1))
                size += len(held[-1])
                if size >= CHUNK_TOKENS:
                    yield chunk(known, held, ids, flags)
                    known, held, ids, flags, size = Vocabulary({b"": 0}), [], [], [], 0
        if held:
            yield chunk(known, held, ids, flags)

    return docs.select("doc_id", "text", "held_out").mapInArrow(work, schema)


# Seating


@dataclass(frozen=True)
class Totals:
    """What all restaurants share: customers and tables of the parent, discounts, known words, totals of split contexts."""

    parent_customers: int
    parent_tables: int
    discount: float
    parent_discount: float
    words: int
    split: np.ndarray  # (code, customers, tables), by code

    def free(self) -> float:
        """The weight of any one word at a new table of the parent."""
        return (STRENGTH + self.parent_discount * self.parent_tables) / (self.words + 1)

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The parent's probability of words with so many customers and tables."""
        return (customers - self.parent_discount * tables + self.free()) / (STRENGTH + self.parent_customers)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after a shift that makes it exact to about 1e-10."""
    y = x + 7.0
    shifted = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(shifted)


def _drawn_tables(count: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """The tables after ``count`` customers of one dish sat down in turn; exact, with one step for each table."""
    tables, at, seated = np.ones(len(count), np.int64), np.arange(len(count)), np.ones(len(count), np.int64)
    while len(at):
        t = tables[at]
        chance = rng.beta(strength[at] + discount * t, seated - discount * t)
        seated = seated + rng.geometric(np.clip(chance, 1e-15, 1.0))
        more = seated <= count[at]
        at, seated = at[more], seated[more]
        tables[at] += 1
    return tables


def _like_strength(count: np.ndarray, room: np.ndarray, p: Callable[[np.ndarray], np.ndarray], discount: float) -> np.ndarray:
    """``r``: a restaurant of one dish and strength ``discount * r`` opens about as many tables as are wanted.

    Any value above -1 gives right samples; a close one gets most proposals accepted.
    """

    def expected(r: np.ndarray) -> np.ndarray:
        s = discount * r
        grown = (np.maximum(count + s + (discount - 1) / 2, 0.5) / (s + 1 + discount / 2)) ** discount
        return np.clip((s + discount) / discount * (s + 1 + discount / 2) / (s + 1) * grown - r, 1.0, count)

    low = np.full(len(count), -1.0 + 1e-6)
    high = np.maximum((room + count) * p(count), 1.0)
    for _ in range(14):
        middle = np.where(high > 1, np.sqrt((low + 1.001) * (high + 1.001)) - 1.001, (low + high) / 2)
        t = np.maximum(expected(middle) - 0.5, 1.0)  # between the last step up and the next
        above = (room + t) * p(t) > middle + t
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return np.maximum((low + high) / 2, -1.0 + 1e-6)


def _seatings(discount: float) -> np.ndarray:
    """[n, t]: the weight of all ways to seat n customers at t tables (generalised Stirling numbers)."""
    ways = np.zeros((SMALL + 1, SMALL + 1))
    ways[1, 1] = 1.0
    for n in range(1, SMALL):
        for t in range(1, n + 2):
            ways[n + 1, t] = ways[n, t - 1] + (n - discount * t) * ways[n, t]
    return ways


def _reseated(tables: np.ndarray, count: np.ndarray, room: np.ndarray, slope: np.ndarray, rest: np.ndarray | None, discount: float, rng: np.random.Generator, start: bool) -> np.ndarray:
    """The tables of each entry (of two customers or more) after all its customers left and sat down again.

    ``room`` is the restaurant's other tables and its strength in tables. The parent's probability is
    ``slope * (rest + t)`` beside ``t`` tables of this entry, or ``slope`` without ``rest``. At the ``start``, while
    the sums still move, what is proposed for large entries is taken as it is; so it is where the seating before is
    none of so many customers.
    """
    out, ways = tables.astype(np.int64), _seatings(discount)
    for n in range(2, SMALL + 1):
        at = np.flatnonzero(count == n)
        if len(at):
            # products of at most SMALL factors, none of which is far from 1 enough to leave the range of doubles
            rooms, beside, weight, total, grown = discount * room[at], None if rest is None else rest[at], slope[at], 0.0, []
            ways_in = np.ones(len(at))
            for i in range(n):
                ways_in = ways_in * weight * (rooms + discount * i) * (1.0 if beside is None else beside + i)
                total = total + ways_in * ways[n, i + 1]
                grown.append(total)
            draw = rng.random(len(at)) * total
            out[at] = 1 + sum((g < draw).astype(np.int64) for g in grown[:-1])
    at = np.flatnonzero(count > SMALL)
    if not len(at):
        return out
    tables, count, room, slope, rest = out[at], count[at], room[at], slope[at], None if rest is None else rest[at]
    p = (lambda t: slope) if rest is None else (lambda t: slope * (rest + t))
    like = _like_strength(count, room, p, discount)
    proposed = _drawn_tables(count, discount * like, discount, rng)

    def weight_of(t: np.ndarray) -> np.ndarray:
        """Log of the wanted probability of ``t`` tables to the proposed one; the ways to seat them cancel."""
        found = _log_gamma(room + t) - _log_gamma(like + t) + t * np.log(slope)
        return found if rest is None else found + _log_gamma(rest + t)

    taken = -rng.exponential(size=len(count)) < weight_of(proposed) - weight_of(tables)
    out[at] = np.where(taken | start | (tables > count), proposed, tables)
    return out


@dataclass
class Rooms:
    """The entries of a bucket: their context's and word's place, customers; words go by home, then code.

    Of the split contexts the places, codes and homes; of each home that is told of words or split contexts, where its words end.
    """

    context: np.ndarray
    word: np.ndarray
    count: np.ndarray
    split: np.ndarray
    split_codes: np.ndarray
    split_homes: np.ndarray
    homes: np.ndarray
    ends: np.ndarray

    @staticmethod
    def of(block: bytes) -> Rooms:
        steps, *rest = _unpack(block)
        return Rooms(np.cumsum(steps), *rest)

    def packed(self) -> bytes:
        return _pack(_steps(self.context), self.word, self.count, self.split, self.split_codes, self.split_homes, self.homes, self.ends)

    def per_context(self, numbers: np.ndarray) -> np.ndarray:
        """Sums over the entries of each context, all of which have some."""
        return np.bincount(self.context, weights=numbers)

    def per_word(self, numbers: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=numbers).astype(np.int64)

    def all_tables(self, several: np.ndarray) -> np.ndarray:
        """The tables of each entry: one for a single customer, ``several`` for those of more."""
        tables = np.minimum(self.count, 1)
        tables[self.count > 1] = several
        return tables

    def totals(self, tables: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of each context, those of split ones being the sums over all buckets."""
        customers, of_context = self.per_context(self.count), self.per_context(tables)
        if len(shared):
            at = np.minimum(np.searchsorted(shared[:, 0], self.split_codes), len(shared) - 1)
            known = shared[at, 0] == self.split_codes
            customers[self.split[known]], of_context[self.split[known]] = shared[at[known], 1], shared[at[known], 2]
        return customers, of_context

    def report(self, name: str, tables: np.ndarray, *first: np.ndarray) -> list[tuple]:
        """What the homes of words are told: tables of each word here, totals of split contexts; at ``first``, what stays as it is."""
        sums = [self.per_word(tables), *first]
        customers, of_context = (self.per_context(x)[self.split].astype(np.int64) for x in (self.count, tables))
        rows, start = [], 0
        for to, end in zip(self.homes.tolist(), self.ends.tolist(), strict=True):
            own = np.flatnonzero(self.split_homes == to)
            data = _pack(self.split_codes[own], customers[own], of_context[own], *(x[start:end] for x in sums))
            rows.append(("up", to, name, data, None, None))
            start = end
        return rows


def _grouped(rows: DataFrame, buckets: int, work: Callable[[pa.Table], pa.Table], schema: str, by: str = "bucket") -> DataFrame:
    tasks = max(-(-buckets // 4), min(buckets, rows.sparkSession.sparkContext.defaultParallelism))
    return rows.repartition(tasks, by).groupBy(by).applyInArrow(work, schema)


def _of_kind(table: pa.Table, kind: str) -> list[tuple[str, bytes]]:
    """(sender, data) of the rows of a kind, by sender; senders are buckets or chunks."""
    sender, data = table.column("sender"), table.column("data")
    found = [(sender[i].as_py(), data[i].as_py()) for i, k in enumerate(table.column("kind").to_pylist()) if k == kind]
    return sorted(found, key=lambda x: (len(x[0]), x[0]))


def _gathered(pairs: DataFrame, words: Words) -> DataFrame:
    """The buckets' rooms, what each chunk asked of them, the first reports, and sums of entries of one and two customers."""

    def work(table: pa.Table) -> pa.Table:
        bucket, asked = table.column("bucket")[0].as_py(), _of_kind(table, "pairs")
        g, h, n = (np.concatenate(x) for x in zip(*(_unpack(d) for _, d in asked), strict=True))
        order = np.lexsort((h, g))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(g[order]) != 0) | (np.diff(h[order]) != 0)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        first = order[new]
        contexts, context = np.unique(g[first], return_inverse=True)
        codes, word = np.unique(h[first], return_inverse=True)
        by_home = np.lexsort((codes, words.home(codes)))
        moved = np.empty(len(codes), np.int64)
        moved[by_home] = np.arange(len(codes))
        codes = codes[by_home]
        split = np.flatnonzero(words.parts_of(contexts) > 1)
        home, split_homes = words.home(codes), words.home(contexts[split])
        homes = np.union1d(home, split_homes)
        ends = np.searchsorted(home, homes, "right")
        rooms = Rooms(context, moved[word], np.bincount(place, weights=n).astype(np.int64), split, contexts[split], split_homes, homes, ends)
        rows = [("rooms", bucket, "", rooms.packed(), None, None)]
        at = 0
        for name, data in asked:
            size = json.loads(data[4 : 4 + int.from_bytes(data[:4], "little")])[0][1]
            rows.append(("asked", bucket, name, _pack(_steps(place[at : at + size])), None, None))
            at += size
        ones = [float((rooms.count == i).sum()) for i in (1, 2)]
        rows.append(("sums", bucket, "", None, None, ones))
        first = codes, rooms.per_word(rooms.count), rooms.per_word(rooms.count > 0)
        return _messages(rows + rooms.report(str(bucket), np.minimum(rooms.count, 1), *first))

    return _grouped(pairs, words.buckets, work, _MESSAGE)


def _numbers_back(table: pa.Table) -> list[np.ndarray]:
    """The arrays sent by the homes, which are in the order of the rooms' words."""
    return [np.concatenate(x) for x in zip(*(_unpack(d) for _, d in _of_kind(table, "down")), strict=True)]


def _seated(rows: DataFrame, words: Words, totals: Totals, number: int, start: bool, sample: bool) -> DataFrame:
    """A pass over the context restaurants; a ``sample`` first notes the seating that the words' numbers belong to."""

    def work(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        rooms = Rooms.of(_of_kind(table, "rooms")[0][1])
        at = np.flatnonzero(rooms.count > 1)
        held = _of_kind(table, "seats")
        several, *noted = _unpack(held[0][1]) if held else [np.ones(len(at), np.int32)]
        noted += [several] if sample else []
        customers, parents = _numbers_back(table)
        rng = np.random.default_rng([number, bucket])
        of_word, of_context = rooms.word[at], rooms.context[at]
        kept = 1.0 - totals.parent_discount * parents[of_word] / np.maximum(customers[of_word], 1)
        rest = customers[of_word] - several + totals.free() / kept
        slope = kept / (STRENGTH + totals.parent_customers)
        tables = rooms.all_tables(several)
        here = rooms.per_context(tables)
        elsewhere = rooms.totals(tables, totals.split)[1] - here
        for _ in range(START_SWEEPS if start else 1):
            in_room = elsewhere + rooms.per_context(tables)
            room = in_room[of_context] - tables[at] + STRENGTH / totals.discount
            tables[at] = _reseated(tables[at], rooms.count[at], room, slope, rest, totals.discount, rng, start)
        data = _pack(tables[at].astype(np.int32), *noted)
        return _messages([("seats", bucket, "", data, None, None), *rooms.report(str(bucket), tables)])

    return _grouped(rows, words.buckets, work, _MESSAGE)


def _parents(rows: DataFrame, words: Words, totals: Totals | None, number: int, start: bool, sample: bool, last: bool) -> DataFrame:
    """A pass over the word restaurant: customers are added up, seated, and the numbers of each word sent back.

    Without totals every word has one table; this first pass also notes the words that each bucket tells of, their tokens and
    contexts, for the passes after it. A ``sample`` is noted; the ``last`` pass sends all that were.
    """

    def work(table: pa.Table) -> pa.Table:
        bucket, told = table.column("bucket")[0].as_py(), _of_kind(table, "up")
        g, g_customers, g_tables, customers, *first = ([*x] for x in zip(*(_unpack(d) for _, d in told), strict=True))
        sizes = np.array([len(x) for x in customers])
        if first:
            own, place = np.unique(np.concatenate(first[0]), return_inverse=True)
            n, contexts = (np.bincount(place, weights=np.concatenate(x), minlength=len(own)).astype(np.int64) for x in first[1:])
        else:
            steps, n, contexts = _unpack(_of_kind(table, "home")[0][1])
            place = np.cumsum(steps)
        customers = np.bincount(place, weights=np.concatenate(customers), minlength=len(n)).astype(np.int64)
        held = _of_kind(table, "words")
        parents, *noted = _unpack(held[0][1]) if held else [np.minimum(customers, 1)]
        parents = np.where(customers > 1, parents, customers)
        at = np.flatnonzero(customers > 1)
        if totals and len(at):
            rng = np.random.default_rng([number, bucket, 1])
            slope = np.full(len(at), 1.0 / (totals.words + 1))
            for _ in range(START_SWEEPS if start else 1):
                room = totals.parent_tables - parents[at] + STRENGTH / totals.parent_discount
                parents[at] = _reseated(parents[at], customers[at], np.maximum(room, 1e-9), slope, None, totals.parent_discount, rng, start)
        noted += [customers, parents] if sample else []
        sent = [n, *noted] if last else [customers, parents]
        rows = [("words", bucket, "", _pack(parents, *noted), None, None)]
        if first:
            rows.append(("home", bucket, "", _pack(_steps(place), n, contexts), None, None))
        for (name, _), there in zip(told, np.split(place, np.cumsum(sizes)[:-1]), strict=True):
            rows.append(("down", int(name), str(bucket), _pack(*(x[there] for x in sent)), None, None))
        v = [(n > 0).sum(), customers.sum(), parents.sum(), (contexts == 1).sum(), (contexts == 2).sum()]
        rows.append(("sums", bucket, "", None, None, [float(x) for x in v]))
        split, at = np.unique(np.concatenate(g), return_inverse=True)
        for i, code in enumerate(split):
            v = [float(np.concatenate(x)[at == i].sum()) for x in (g_customers, g_tables)]
            rows.append(("split", bucket, "", None, int(code), v))
        return _messages(rows)

    return _grouped(rows, words.buckets, work, _MESSAGE)


def _sums(rows: DataFrame, size: int) -> list[float]:
    """Sums over all buckets."""
    return [x or 0.0 for x in rows.where("kind = 'sums'").agg(*(F.sum(F.get("v", F.lit(i))) for i in range(size))).first()]


def _totals(told: DataFrame, discounts: Callable[[float, float], tuple[float, float]]) -> Totals:
    known, customers, tables, n1, n2 = _sums(told, 5)
    shared = told.where("kind = 'split'").groupBy("code").agg(*(F.sum(F.get("v", F.lit(i))).alias(f"v{i}") for i in range(2)))
    split = np.array(sorted(tuple(r) for r in shared.collect()), np.float64).reshape(-1, 3)  # COMMON rows at most
    return Totals(int(customers), int(tables), *discounts(n1, n2), int(known), split)


def _discount(one: float, two: float) -> float:
    return min(0.95, max(0.05, one / (one + 2 * two))) if one + two else 0.5


# Scores


def _answers(rows: DataFrame, words: Words, samples: list[Totals]) -> DataFrame:
    """For each chunk, the averaged probability and the word's tokens of each pair it asked for."""

    def work(table: pa.Table) -> pa.Table:
        rooms = Rooms.of(_of_kind(table, "rooms")[0][1])
        current, *seats = _unpack(_of_kind(table, "seats")[0][1])
        seats.append(current)  # the last sample, noted by no later pass
        n, *parent = _numbers_back(table)
        total = np.zeros(len(rooms.count))
        for i, t in enumerate(samples):
            tables = rooms.all_tables(seats[i])
            customers, of_context = rooms.totals(tables, t.split)
            below = STRENGTH + customers
            back = (STRENGTH + t.discount * of_context) / below
            total += (rooms.count - t.discount * tables) / below[rooms.context]
            total += back[rooms.context] * t.parent(parent[2 * i], parent[2 * i + 1])[rooms.word]
        log_p, tokens = np.log10(total / len(samples)).astype(np.float32), n[rooms.word]
        bucket, out = table.column("bucket")[0].as_py(), []
        for name, data in _of_kind(table, "asked"):
            at = np.cumsum(_unpack(data)[0])
            out.append(("answer", bucket, name, _pack(log_p[at], tokens[at]), None, None))
        return _messages(out)

    return _grouped(rows, words.buckets, work, _MESSAGE)


def _scored(chunks: DataFrame, answers: DataFrame, words: Words) -> DataFrame:
    doc_type = chunks.schema["ids"].dataType.elementType.simpleString()
    schema = f"doc_id {doc_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def work(table: pa.Table) -> pa.Table:
        kinds, buckets = table.column("kind").to_pylist(), table.column("bucket").to_pylist()
        own = kinds.index("chunk")
        lengths, place = _unpack(table.column("data")[own].as_py())
        parts = sorted((b, i) for i, (k, b) in enumerate(zip(kinds, buckets, strict=True)) if k == "answer")
        log_p, n = (np.concatenate(x) for x in zip(*(_unpack(table.column("data")[i].as_py()) for _, i in parts), strict=True))
        base = np.log10((n + 0.5) / (words.tokens + 0.5 * (words.words + 1)))
        starts = np.cumsum(lengths) - lengths
        add = lambda x: pa.array(np.add.reduceat(x[place], starts))
        ids, held = (table.column(c).combine_chunks().slice(own, 1).flatten() for c in ("ids", "held"))
        train_tokens = pa.array(np.full(len(lengths), words.tokens, np.int64))
        columns = [ids, held, pa.array(lengths.astype(np.int64)), add((n > 0).astype(np.int64)), train_tokens, add(base), add(log_p.astype(np.float64))]
        return pa.Table.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return _grouped(chunks.unionByName(answers, allowMissingColumns=True), words.buckets, work, schema, by="sender")


@dataclass(frozen=True)
class Fitted:
    """The scored rows, and the totals at each sample."""

    scored: DataFrame
    samples: list[Totals]


def fit(docs: DataFrame, held_out: Column) -> Fitted:
    """Learn from the rows of ``docs`` that are not ``held_out`` (null: not), and score all of them.

    What a pass needs of the pass before is written to the shared folder, and only the last is kept.
    """
    given = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    words = _words(given.where(~F.col("held_out")))
    sent = settle(_pairs(given, words), "lm-pairs", by="kind")
    chunks, pairs = (sent.where(F.col("kind") == k) for k in ("chunk", "pairs"))
    pairs = pairs.drop("ids", "held").select(*_NAMES)
    held = settle(_gathered(pairs, words), "lm-rooms", by="kind").select(*_NAMES)
    rooms, asked, up = (held.where(F.col("kind") == k) for k in ("rooms", "asked", "up"))
    drop_settled(sent, kind="pairs")
    discount = _discount(*_sums(held, 2))

    told = settle(_parents(up, words, None, 0, True, False, False), "lm-parents", by="kind").select(*_NAMES)
    home = told.where("kind = 'home'")
    drop_settled(held, kind="up")
    totals = _totals(told, lambda n1, n2: (discount, _discount(n1, n2)))
    fixed = lambda n1, n2, d=(totals.discount, totals.parent_discount): d
    passes, samples, seats = STARTS + BURN_IN + SAMPLES, [], None
    # the seating after pass i and the words' numbers for it make sample i, noted on both sides
    for i in range(1, passes + 1):
        start, sampled = i <= STARTS, i > STARTS + BURN_IN
        down, before = told.where("kind = 'down'"), (seats, told)
        given_rows = rooms.union(down) if seats is None else rooms.union(down).union(seats.where("kind = 'seats'"))
        seats = settle(_seated(given_rows, words, totals, i, start, i - 1 > STARTS + BURN_IN), "lm-seats", by="kind").select(*_NAMES)
        rows = seats.where("kind = 'up'").union(told.where("kind = 'words'")).union(home)
        told = settle(_parents(rows, words, totals, i, start, sampled, i == passes), "lm-parents", by="kind").select(*_NAMES)
        if i == 1:  # its homes stay
            drop_settled(before[1], kind="words")
            drop_settled(before[1], kind="down")
        else:
            drop_settled(*before)
        totals = _totals(told, fixed)
        samples += [totals] if sampled else []
    last = seats.where("kind = 'seats'")
    answers = settle(_answers(rooms.union(asked).union(last).union(told.where("kind = 'down'")), words, samples), "lm-answers")
    drop_settled(held, home, seats, told)
    return Fitted(_scored(chunks, answers, words), samples)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Scores are log10 probabilities of the whole text.
    """
    return fit(docs, held_out).scored


def perplexity(scored: DataFrame) -> DataFrame:
    """Per part of the corpus (``held_out``): perplexity per token of the model and of the base."""
    tokens = F.sum("n_tokens")
    return scored.groupBy("held_out").agg(*(F.pow(F.lit(10.0), -F.sum(c) / tokens).alias(f"{c}_perplexity") for c in ("score", "base_score")))
