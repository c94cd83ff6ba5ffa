from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from ledgerline.llm import simhash

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def plain_print(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "").translate(LOW)).split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def brute(rows):
    prints = [plain_print(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                label[find(i)] = find(j)
    least = {}
    for i, (own, _) in enumerate(rows):
        if own is not None:
            least[find(i)] = min(own, least.get(find(i), own))
    return sorted(((own, f"{p:016x}", least.get(find(i))) for i, ((own, _), p) in enumerate(zip(rows, prints))), key=str)


def found(docs):
    return sorted((tuple(r) for r in simhash.near_copies(docs).collect()), key=str)


@pytest.mark.parametrize("tile,least", [(512, 64), (3, 0.001)])
def test_equals_brute_force(spark, docs_of, corpus, monkeypatch, tile, least):
    """Copies, near copies, short, empty and null texts, null and repeated ids; also with tiny tiles and many parts."""
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "LEAST", least)
    rows = [*corpus, (400, "x" * 100_000), (401, "many words of one text " * 5000), (None, "one TWO"), (None, "alone here")]
    assert found(docs_of(*rows)) == brute(rows)


@pytest.mark.parametrize("parts", [1, 2, 4, 8, 16])
def test_no_pair_within_the_radius_is_skipped(spark, parts):
    """Tile keys of two fingerprints that differ by up to two bits are a step apart."""
    rng = random.Random(parts)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(3)):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    rows = spark.createDataFrame(pairs, "a long, b long")
    keys = rows.select(simhash.tile_key(rows.a, parts).alias("a"), simhash.tile_key(rows.b, parts).alias("b")).collect()
    known = set(simhash.steps(parts, 2))
    assert all(abs(k.a - k.b) in known for k in keys)


def test_links_of_planted_fingerprints(spark):
    """Chains, a dense ball and all-ones among random ones, against all pairs."""
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(400)} | {0, 2**64 - 1, 2**63, 1}
    chain = rng.getrandbits(64)
    for bit in range(0, 30, 2):
        chain ^= 3 << bit
        prints.add(chain)
    ball = rng.getrandbits(64)
    prints |= {ball ^ (1 << x) ^ (1 << y) for x in range(12) for y in range(12)}
    prints = sorted(prints)
    rows = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fingerprint long")
    edges = [tuple(r) for r in simhash.links(rows, len(prints)).collect()]
    assert len(edges) < 10 * len(prints)

    def classes(pairs):
        up = {x: x for x in prints}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            up[find(a)] = find(b)
        groups = {}
        for x in prints:
            groups.setdefault(find(x), set()).add(x)
        return sorted(map(sorted, groups.values()))

    unsigned = [(a % (1 << 64), b % (1 << 64)) for a, b in edges]
    assert all((a ^ b).bit_count() for a, b in unsigned)
    assert classes(unsigned) == classes((a, b) for a in prints for b in prints if 0 < (a ^ b).bit_count() <= 2)


def test_a_forest_keeps_connections():
    left = np.array([0, 7, 255 << 40], np.int64)
    right = np.array([1, 3, 255 << 20], np.int64)
    low, high = simhash.forest(left, right, 2)
    assert sorted(zip(low.tolist(), high.tolist())) == [(0, 1), (0, 3), (0, 7)]


def test_empty_table(docs_of):
    assert simhash.near_copies(docs_of()).count() == 0
