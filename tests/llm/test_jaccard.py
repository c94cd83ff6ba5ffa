from __future__ import annotations

import random
import re

import numpy as np
import pytest
from ledgerline.llm import jaccard


def brute(rows):
    low = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


@pytest.mark.parametrize("block,leaf", [(512, 16), (3, 2)])
def test_equals_brute_force(spark, docs_of, corpus, monkeypatch, block, leaf):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    got = jaccard.join_components(docs_of(*corpus)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(corpus)


def test_a_family_without_a_common_centre(spark, docs_of):
    """A chain: each links to the next only, so the pivot does not settle it."""
    rng = random.Random(9)
    tokens = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(25):
        rows.append((i, " ".join(tokens)))
        tokens = [*tokens[4:], *(f"n{i}_{k}" for k in range(4))]
    rng.shuffle(rows)
    assert sorted((tuple(r) for r in jaccard.join_components(docs_of(*rows)).collect()), key=str) == brute(rows)


def test_empty_table(docs_of):
    assert jaccard.join_components(docs_of()).count() == 0


def test_the_tree_lets_all_similar_pairs_through():
    rng = np.random.default_rng(1)
    sets = [rng.choice(4000, size=rng.integers(20, 120), replace=False) for _ in range(60)]
    sets += [np.concatenate([s[:-1], rng.choice(np.arange(4000, 5000), 1)]) for s in sets]
    n = np.array([len(s) for s in sets])
    sets += [np.arange(i, i + 900) for i in range(0, 400, 40)]  # larger ones have more groups
    n = np.array([len(s) for s in sets])
    tree = jaccard._Tree(n, [jaccard.point(s.astype(np.uint64)) for s in sets])
    found = {tuple(sorted(p)) for p in zip(*(x.tolist() for x in tree.pairs(tree, 80)))}
    for i in range(len(sets)):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 80 * (n[i] + n[j] - shared):
                assert (j, i) in found
