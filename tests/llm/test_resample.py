from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from ledgerline.llm import resample

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=5):
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for g in features(text)[1]:
                counts[bucket(g)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000) / ((a + 1) * (sum(t) + 10000)))) for a, b in zip(s, t)]
    out, able = [], []
    for own, text in rows:
        n, grams = features(text)
        weight = sum(gain[bucket(g)] for g in grams)
        h = int(hashlib.sha256(f"42:{'' if own is None else own}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([own, len(grams), weight, score, None])
        if n >= 20:
            able.append(len(out) - 1)
    able.sort(key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0, out[i][1]))
    for rank, i in enumerate(able[: percent * len(able) // 100], 1):
        out[i][4] = rank
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("segment,percent", [(1 << 17, 5), (7, 60)])
def test_equals_brute_force(spark, docs_of, corpus, monkeypatch, segment, percent):
    """Short, empty and null texts, null and repeated ids, repeated rows, a very long text; also in tiny segments."""
    monkeypatch.setattr(resample, "SEGMENT", segment)
    monkeypatch.setattr(resample, "BATCH_BYTES", 50 * segment)
    rng = random.Random(4)
    rows = [*corpus, *[(500, corpus[0][1])] * 30, (600, "naïve Ünï " * 3000), (601, "x" * 70000 + " y"), (602, "a1-b2_c3\x00d")]
    rows += [(700 + i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=25))) for i in range(60)]
    target = ["alpha beta gamma alpha", corpus[3][1], None, ""]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id int, text string, weight int")
    found = resample.resample(docs_of(*rows), benchmark, percent).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, target, percent)


def test_empty_tables(spark, docs_of, corpus):
    none = spark.createDataFrame([], "item_id int, text string")
    assert resample.resample(docs_of(), none).count() == 0
    found = sorted((tuple(r) for r in resample.resample(docs_of(*corpus), none).collect()), key=str)
    assert found == brute(corpus, [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=90), min_size=1, max_size=30), st.integers(1, 3))
def test_hashes_of_spans(spans, few):
    before, resample._FEW = resample._FEW, few
    try:
        spans = [s for s in spans for _ in range(few)]
        text = resample.Bytes(b" ".join(spans))
        length = np.array([len(s) for s in spans])
        start = np.cumsum(length + 1) - length - 1
        assert text.by_length(start, length, np.uint64, text.xxhash64, None).tolist() == [xxhash.xxh64_intdigest(s) for s in spans]
        assert text.by_length(start, length, np.int64, text.crc32, None).tolist() == [zlib.crc32(s) for s in spans]
    finally:
        resample._FEW = before


def test_equal_keys_are_told_apart_by_their_bytes():
    """With one key for all runs, only the bytes and lengths keep them apart."""
    words = [b"one", b"two", b"one", b"twelve bytes", b"twelve bytez", b"twelve bytes", b"on"] * 3
    text = resample.Bytes(b" ".join(words))
    length = np.array([len(w) for w in words])
    start = np.cumsum(length + 1) - length - 1
    slot, holder = resample.Runs._intern(text, start, length, np.full(len(words), 5, np.uint64), 64)
    assert len(set(zip(slot.tolist(), words))) == len(set(words)) == len(set(slot.tolist()))
    assert all(words[holder[s]] == w for s, w in zip(slot.tolist(), words))
