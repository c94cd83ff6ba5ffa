"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may be altered by up to k edits (insertions, deletions, replacements). Cut into k + 1
pieces, at least one piece must then stand unaltered in any altered copy. So all pieces of all items are looked up
in the documents in one pass (a keyword automaton), each hit fixes where the copy would have to lie, and
bit-parallel edit distance over that stretch (Myers) says whether it is within the budget.

Texts are compared in lower case with runs of white space as one blank.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.common import arrow_rows

#: One edit is allowed for this many characters of an item.
CHARS_PER_EDIT = 20
#: Characters of items in one automaton; more items than that are matched in further passes.
GROUP_CHARS = 4_000_000
BATCH = 256


def normal(text: str) -> str:
    """Lower case, blanks collapsed and trimmed."""
    return " ".join(text.lower().split())


def budget(length: int) -> int:
    return length // CHARS_PER_EDIT


def split_item(text: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): ``edits + 1`` pieces of nearly equal length."""
    cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | 1 << i
    return masks


def closest(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(distance, end) of the substring of ``text`` closest to the pattern; the first end on ties."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for at, char in enumerate(text, 1):
        same = masks.get(char, 0)
        vertical = same | minus
        diagonal = ((((same & plus) + plus) ^ plus) | same) & full
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """All pieces of some items in one automaton."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items = [(item_id, text, budget(len(text)), pattern_masks(text)) for item_id, text in items]
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, edits, _) in enumerate(self.items):
            for offset, piece in split_item(text, edits):
                by_piece.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in by_piece.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if by_piece:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, distance, end) of the closest copy of each item found in a normalised text."""
        begins: dict[int, list[int]] = {}
        if len(self.automaton):
            for end, (size, uses) in self.automaton.iter(text):
                for number, offset in uses:
                    begins.setdefault(number, []).append(end + 1 - size - offset)
        out = []
        for number, starts in begins.items():
            item_id, pattern, edits, masks = self.items[number]
            whole = next((s for s in starts if s >= 0 and text.startswith(pattern, s)), None)
            if whole is not None:
                out.append((item_id, 0, whole + len(pattern)))
                continue
            near = []
            for low, high in _stretches(starts, edits, len(pattern), len(text)):
                distance, end = closest(masks, len(pattern), text[low:high])
                if distance <= edits:
                    near.append((distance, low + end))
            if near:
                out.append((item_id, *min(near)))
        return sorted(out)


def _stretches(starts: list[int], edits: int, size: int, end: int) -> list[tuple[int, int]]:
    """Where copies that begin within ``edits`` of the starts can lie; overlapping stretches become one."""
    out: list[tuple[int, int]] = []
    for start in sorted(set(starts)):
        low, high = max(0, start - edits), min(end, start + size + edits)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _groups(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in groups of bounded size, each brought to the driver by itself."""
    sized = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = -(-total // GROUP_CHARS) or 1
    for group in range(groups):
        part = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group)
        items = sorted({(row.item_id, normal(row.text)) for row in part.collect()})
        yield [(i, t) for i, t in items if t]


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, distance, end``: the closest copy of each item in each document that holds one.

    ``end`` counts characters of the normalised text. Items with a null id or without any character but blanks
    take no part, nor do null texts; documents are matched row by row, whatever their ids. Items of fewer than
    ``CHARS_PER_EDIT`` characters must occur unaltered. Ids of both tables may be of any simple type and keep it. The items travel in groups of bounded size, one pass over
    the documents for each, so a benchmark of any size is matched whole.
    """
    doc_type, item_type = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType
    item_arrow = to_arrow_type(item_type)

    def work(items: list[tuple[int, str]]):
        def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items)
            for batch in arrow_rows(batches, BATCH):
                found = [(i, *x) for i, t in enumerate(batch.column("text").to_pylist()) for x in matcher.find(normal(t))]
                if found:
                    row, item, distance, end = zip(*found, strict=True)
                    columns = [batch.column("doc_id").take(pa.array(row)), pa.array(item, item_arrow), pa.array(distance, pa.int32()), pa.array(end, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "distance", "end"])

        return one

    given = docs.select("doc_id", "text").where("text IS NOT NULL")
    passes = [given.mapInArrow(work(items), f"doc_id {doc_type}, item_id {item_type.simpleString()}, distance int, end long") for items in _groups(benchmark)]
    return functools.reduce(DataFrame.unionByName, passes)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that hold no copy of an item; null texts hold none."""

    def work(items: list[tuple[int, str]]):
        def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items)
            for batch in arrow_rows(batches, BATCH):
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                yield batch.filter(pa.array([t is None or not matcher.find(normal(t)) for t in texts], pa.bool_()))

        return one

    for items in _groups(benchmark):
        docs = docs.mapInArrow(work(items), docs.schema)
    return docs
