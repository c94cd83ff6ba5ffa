from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from ledgerline.llm import suffix


def brute(rows):
    data = [(i, b"" if t is None else t.encode()) for i, t in rows]
    seen = {}
    for _, b in data:
        for s in range(len(b) - 399):
            seen[b[s : s + 400]] = seen.get(b[s : s + 400], 0) + 1
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, int)
        for s in range(len(b) - 399):
            if seen[b[s : s + 400]] > 1:
                gone[s] += 1
                gone[s + 400] -= 1
        covered = np.cumsum(gone)[: len(b)] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(int), [0]])))
        kept = bytes(np.frombuffer(b, np.uint8)[~covered])
        out.append((i, len(b), [tuple(x) for x in edges.reshape(-1, 2).tolist()], hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)
    letters = "abcdefgh éß"
    make = lambda n: "".join(rng.choices(letters, k=n))
    base = [make(rng.randrange(500, 3000)) for _ in range(6)]
    rows = list(enumerate(base))
    for i in range(14):
        chars = list(rng.choice(base))
        for _ in range(rng.randrange(5)):
            chars[rng.randrange(len(chars))] = "X"
        rows.append((100 + i, make(rng.randrange(300)) + "".join(chars[rng.randrange(200) :]) + make(rng.randrange(50))))
    passage = make(420)
    rows += [(200 + i, make(100) + passage[i : 405 + i] + make(90)) for i in range(8)]
    rows += [(300, "a" * 1500), (301, "abc" * 400), (302, ("line of text %03d\n" % 7) * 60), (303, None), (304, ""), (305, "short"), (306, base[0][:400]), (307, base[1][:399])]
    return rows + [(308, base[2]), (308, base[2]), (None, base[3]), (None, make(600)), (309, make(700) * 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(docs_of, seed):
    rows = texts(seed)
    got = suffix.dedup(docs_of(*rows), with_text=True).collect()
    found = sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in got), key=str)
    assert found == brute(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_many_rows_without_an_id(docs_of):
    """Rows of no id are named by their texts, so no group holds them all; many equal rows are one there."""
    rng = random.Random(7)
    base = ["".join(rng.choices("abcdefgh ", k=600)) for _ in range(900)]
    rows = [(None, t) for t in base] + [(None, "x" * 50 + t) for t in base] + [(None, base[0])] * 200
    with_ids = [(i, t) for i, (_, t) in enumerate(rows)]
    results = [suffix.dedup(docs_of(*given)).collect() for given in (rows, with_ids)]
    plain = [sorted((r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in found) for found in results]
    assert plain[0] == plain[1] and all(spans for _, spans, _ in plain[0])


def test_pieces_of_a_long_text(docs_of, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 700)
    rows = texts(5)
    got = suffix.dedup(docs_of(*rows)).collect()
    assert sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("depth", [1, 2, 3, 9, 27])
def test_suffix_order(spark, depth):
    rng = random.Random(depth)
    strings = [(i, [rng.randrange(3) for _ in range(rng.randrange(1, 14))]) for i in range(60)]
    strings += [(100 + i, strings[i][1]) for i in range(10)]
    frame = spark.createDataFrame(strings, "id bigint, chars array<bigint>")
    ranks = {r.id: r.ranks for r in suffix.suffix_ranks(frame, depth).collect()}
    suffixes = [(ranks[i][j], s[j:]) for i, s in strings for j in range(len(s))]
    assert all(len(ranks[i]) == len(s) for i, s in strings)
    ordered = [s for _, s in sorted(suffixes, key=lambda x: x[0])]
    for a, b in zip(ordered, ordered[1:]):
        assert a[:depth] <= b[:depth]


def test_empty_table(docs_of):
    assert suffix.dedup(docs_of()).count() == 0
    got = suffix.dedup(docs_of((1, "x"))).first()
    assert (got.n_bytes, got.spans) == (1, [])


def test_lists_and_spans_of_ids_over_many_batches(spark):
    """An id's rows that reach over the ends of batches make one list, in order, and one row of maximal runs."""
    rng = random.Random(9)
    rows = [(i, j, rng.randrange(10**9)) for i in range(-20, 20) for j in range(rng.randrange(1, 9))]
    spans = [(i, s := rng.randrange(60), s + rng.randrange(1, 9)) for i in range(30) for _ in range(rng.randrange(1, 12))]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        given = spark.createDataFrame(rng.sample(rows, len(rows)), "id long, j long, rank long")
        lists = [(r.id, r.ranks) for r in suffix._lists(given, "rank", "ranks").collect()]
        joined = [(r.id, [tuple(s) for s in r.spans]) for r in suffix._joined_spans(spark.createDataFrame(spans, "id long, start long, end long")).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(lists) == [(i, [v for k, _, v in rows if k == i]) for i in range(-20, 20)]
    assert sorted(joined) == [(i, suffix._merged([(a, b) for k, a, b in spans if k == i])) for i in range(30)]
