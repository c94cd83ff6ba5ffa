from __future__ import annotations

import hashlib
import json
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from ledgerline.llm import align
from tokenizers import Tokenizer

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    whole = Tokenizer.from_file(A)
    whole.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
    with open(A, encoding="utf-8") as file:
        a_bytes = {i: bytes(letters.get(c, 63) for c in t) for t, i in json.load(file)["model"]["vocab"].items()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)

    def b_bytes(i):
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(text):
        a, b = whole.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        return [(i, a_bytes[i]) for i in a], [(i, b_bytes(i)) for i in b]

    return encode


def brute(rows, encode):
    docs, held = [], Counter()
    for own, text in rows:
        groups = []
        if text:
            a, b = encode(text)
            if b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                ends = []
                for side in (a, b):
                    at, found = 0, []
                    for i, x in side:
                        at += len(x)
                        found.append((at, i))
                    ends.append(found)
                cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
                low = 0
                for high in cuts:
                    groups.append([[i for e, i in side if low < e <= high] for side in ends])
                    low = high
        docs.append((own, groups))
        held.update({(i, j) for x, y in groups for i in x for j in y})
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    out = []
    for own, groups in docs:
        links = [(i, j) for x, y in groups for i in x for j in y]
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        numbers = [sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links)]
        out.append((own, *numbers, sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), sha))
    return sorted(out, key=str)


TEXTS = [
    "It's the DON'T we'll 12a³ naïve ÇA  va? x\x85y", "Σίσυφος ΟΔΟΣ", "a\x1cb c", "<|endoftext|> x </s> <unk> <0x41>", "日本 語 です 日本語", "— “quote”",
    " lead", "  two", "trail ", "trail\n", "\n\nlines\n a\nb \n c\r\nd\te", " ", "\n", "a▁b one", "▁", "ﬁ ²½ é é", "😀😀 👩‍👩‍👧 😀", "\x00 nul", "  nbsp　wide x",
    "thorreou ndernt\nthorreou ndernt thorreou", "1234567 89 1234567", "zzzzqx zq next", "x﻿y ﻿",
]


@pytest.mark.parametrize("units", [1 << 16, 8])
def test_equals_brute_force(spark, docs_of, corpus, tokenizers, monkeypatch, units):
    """Odd characters, blanks and lines, null and empty texts, null and repeated ids, long words and texts; also in tiny chunks."""
    monkeypatch.setattr(align, "UNITS", units)
    rows = [*corpus, *enumerate(TEXTS, 1000), (1, "again " * 4000), (2, "x" * 20000), (3, "日本語" * 2000), (None, TEXTS[0]), (None, TEXTS[4])]
    found = sorted((tuple(r) for r in align.align(docs_of(*rows), A, B).collect()), key=str)
    assert found == brute(rows, tokenizers)


def test_documents_of_the_smallest_scale(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = sorted((tuple(r) for r in align.align(docs, A, B).collect()), key=str)
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()], tokenizers)


def test_whole_texts_where_units_are_not_safe(tokenizers):
    by = align.Aligner(A, B)
    assert by.by_unit
    by.by_unit = False
    for text in TEXTS[:6]:
        found = by.align(by.units(text))
        a, b = tokenizers(text)
        assert (found.n_a.tolist(), found.n_b.tolist()) == ([len(a)], [len(b)])


def test_identity_map():
    by = align.Aligner(A, B)
    for a, b in enumerate(by.identity.tolist()):
        assert b < 0 or by.a.bytes[a] == by.b.bytes[b]
    assert (by.identity >= 0).sum() > 20_000


def test_empty_table(docs_of):
    assert align.align(docs_of(), A, B).count() == 0
