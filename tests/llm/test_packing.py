from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from ledgerline.llm import packing
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 60), max_size=40))
def test_plans_hold_every_piece_once(counts):
    placed = Counter()
    bins = 0
    for number, pattern in packing.plan_bins(counts, 100):
        assert sum(n * each for n, each in pattern) <= 100
        bins += number
        for n, each in pattern:
            placed[n] += number * each
    assert placed == Counter(counts)
    total = sum(n * c for n, c in counts.items())
    large = sum(c for n, c in counts.items() if n > 50)
    assert bins <= max(large, -(-total // 100)) * 1.5 + 1


def test_large_pieces_pair():
    assert sorted(packing.plan_bins({60: 2, 40: 2, 35: 2}, 100)) == [(1, ((35, 2),)), (2, ((60, 1), (40, 1)))]
    assert packing.plan_bins({}, 100) == []


TEXTS = [
    "It's the DON'T we'll 12a³ naïve ÇA  va? x\x85y", "Σίσυφος ΟΔΟΣ", "a\x1cb", "<|endoftext|> x", "étude İstanbul", "日本 語", "— “quote”",
    "!!??", "'s's", "ǅ ß ſ", "", " \n\t ", "x" * 5000, " a b", "ﬁ ²½", "ẞ ẞ", "1'd2",
]


def test_words_encode_as_whole_texts_do():
    whole = Tokenizer.from_file(PATH)
    encoder = packing.Encoder(PATH)
    assert encoder.by_word
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(TEXTS)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_pieces_and_places(spark, docs_of, corpus, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 5)
    whole = Tokenizer.from_file(PATH)
    docs = docs_of(*corpus)
    placed = packing.place(packing.tokenise(docs, PATH, capacity=64, with_ids=True), capacity=64)
    rows = placed.collect()
    wanted = Counter()
    for i, t in corpus:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        for p, s in enumerate(range(0, len(ids), 64)):
            part = ids[s : s + 64]
            wanted[i, p, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 64
    packed = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    assert {k: len(v) for k, v in packed.items()} == dict(ends)


def test_empty_table(spark, docs_of):
    assert packing.place(packing.tokenise(docs_of(), PATH)).count() == 0


@pytest.mark.parametrize("length,pieces", [(4095, 1), (4096, 2)])
def test_only_longer_documents_are_cut(spark, docs_of, length, pieces):
    got = packing.tokenise(docs_of((1, "a " * length)), PATH).collect()
    assert [r.length for r in got] == [4096, 1][:pieces]
