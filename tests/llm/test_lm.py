from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from ledgerline.llm import lm
from ledgerline.llm.common import remainder, remainder_of
from pyspark.sql import functions as F


def tokens(text):
    low = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low)), ""]


def chained(count, rng):
    """Each word allows a few followers only."""
    words = [f"{a}{i}" for i in range(20) for a in ("xa", "yb", "zc")]
    follow = {w: rng.sample(words, 3) for w in words}
    rows = []
    for i in range(count):
        w, text = rng.choice(words), []
        for _ in range(40):
            text.append(w)
            w = rng.choice(follow[w])
        rows.append((i, " ".join(text)))
    return rows


@pytest.fixture(params=["one bucket", "many buckets"])
def buckets(request, monkeypatch):
    """Few common words, split contexts and small chunks, or all in one place."""
    if request.param == "many buckets":
        for name, value in (("COMMON", 4), ("BUCKET_TOKENS", 1500), ("CHUNK_TOKENS", 900), ("BATCH", 7)):
            monkeypatch.setattr(lm, name, value)


def test_base_counts_and_held_out_perplexity(docs_of, buckets):
    rows = chained(200, random.Random(8))
    rows += [(1000, None), (1001, ""), (1002, "New WORDS xa1"), (1003, rows[0][1]), (1003, rows[0][1]), (None, "xa1 \x1c yb2"), (1004, "yb3 " * 20_000)]
    held = remainder(F.col("doc_id"), 5) == 1
    got = lm.score(docs_of(*rows), held).collect()
    counts = Counter(w for i, t in rows if remainder_of(i, 5) != 1 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    by_key = Counter()
    for i, t in rows:
        own = tokens(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        by_key[i, remainder_of(i, 5) == 1, len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == by_key
    out = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 200]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score < 0 for r in got)


def test_scores_are_the_same_in_a_second_run(docs_of, buckets):
    """Known and unknown words and contexts; this does not show that probabilities sum to one."""
    rows = chained(40, random.Random(3))
    asked = ["xa1", "xa1 yb2", "unseen", "xa1 other", ""]
    docs = docs_of(*rows, *((1000 + i, t) for i, t in enumerate(asked)))
    once, again = ({r.doc_id: r.score for r in lm.score(docs, F.col("doc_id") >= 1000).collect()} for _ in range(2))
    assert once == pytest.approx(again) and all(x < 0 for x in once.values())


def test_each_restaurant_hands_out_all_of_its_probability(monkeypatch):
    """Of one bucket, worked out by hand: entries' shares and what is left for the parent make one."""
    discount, count, tables = 0.4, [5, 1, 2], [2, 1, 1]
    t = lm.Totals(4, 3, discount, 0.3, 3, lm.np.zeros((0, 3)))
    below = lm.STRENGTH + sum(count)
    own = [(c - discount * x) / below for c, x in zip(count, tables, strict=True)]
    back = (lm.STRENGTH + discount * sum(tables)) / below
    parent = t.parent(lm.np.array([2, 1, 1, 0]), lm.np.array([1, 1, 1, 0]))
    assert sum(own) + back * parent.sum() == pytest.approx(1.0)


def test_exact_seatings():
    """Table numbers of small entries, as of seating customers one by one very often."""
    rng, m = lm.np.random.default_rng(4), 40_000
    for n in (2, 3, 5):
        room, slope, d = 2.5, 0.6, 0.4
        got = lm._reseated(lm.np.ones(m, int), lm.np.full(m, n), lm.np.full(m, room), lm.np.full(m, slope), None, d, rng, False)
        # Gibbs over single customers of one dish beside tables that do not move
        draw, seen, sizes = random.Random(n), Counter(), [n]
        for step in range(60_000):
            k = draw.choices(range(len(sizes)), sizes)[0]
            sizes[k] -= 1
            sizes = [x for x in sizes if x]
            weights = [*(x - d for x in sizes), d * (room + len(sizes)) * slope]
            k = draw.choices(range(len(weights)), weights)[0]
            sizes = [x + (i == k) for i, x in enumerate([*sizes, 0]) if x or i == k]
            seen[len(sizes)] += step > 500
        assert got.mean() == pytest.approx(sum(t * c for t, c in seen.items()) / sum(seen.values()), rel=0.02)


def test_packed_arrays_come_back():
    arrays = [lm.np.array(x, t) for x, t in (([1, -5, 2**62], "i8"), ([], "i4"), ([0.5], "f4"), ([7] * 999, "i4"))]
    assert [(a.dtype, a.tolist()) for a in lm._unpack(lm._pack(*arrays))] == [(a.dtype, a.tolist()) for a in arrays]


def test_nothing_to_learn_from(docs_of):
    got = lm.score(docs_of((1, "a b"), (2, None)), F.lit(True)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score, r.base_score) for r in sorted(got)] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]
    assert lm.score(docs_of(), F.lit(True)).count() == 0


def pairs_of(text):
    own = tokens(text)
    return list(zip(["", *own[:-1]], own, strict=True))


def plain_gibbs(rows, discount, parent_discount, sweeps, burn_in, seed, asked=()):
    """Mean tables of the restaurants and of the parent, each customer moved by itself in each sweep; log10 of the
    averaged probabilities of the texts asked for."""
    rng, strength = random.Random(seed), lm.STRENGTH
    customers = [pair for _, text in rows for pair in pairs_of(text)]
    words = len({w for _, w in customers})
    rooms, parent = {}, {}
    tables, parent_tables, parent_customers = Counter(), 0, 0

    def parent_p(w):
        own = parent.get(w, [])
        return (sum(own) - parent_discount * len(own) + (strength + parent_discount * parent_tables) / (words + 1)) / (strength + parent_customers)

    def join(own, d, fresh):
        weights = [*(n - d for n in own), fresh]
        k = rng.choices(range(len(weights)), weights)[0]
        if k == len(own):
            own.append(0)
        own[k] += 1
        return own[k] == 1

    def enter(u, w):
        nonlocal parent_tables, parent_customers
        if join(rooms.setdefault((u, w), []), discount, (strength + discount * tables[u]) * parent_p(w)):
            tables[u] += 1
            parent_tables += join(parent.setdefault(w, []), parent_discount, (strength + parent_discount * parent_tables) / (words + 1))
            parent_customers += 1

    def leave(own):
        k = rng.choices(range(len(own)), own)[0]
        own[k] -= 1
        if own[k] == 0:
            del own[k]
            return True
        return False

    for u, w in customers:
        enter(u, w)
    means, wanted, samples = [], {pair: 0.0 for text in asked for pair in pairs_of(text)}, 0
    of_context = Counter(u for u, _ in customers)
    for sweep in range(sweeps):
        for u, w in customers:
            if leave(rooms[u, w]):
                tables[u] -= 1
                parent_customers -= 1
                parent_tables -= leave(parent[w])
            enter(u, w)
        if sweep >= burn_in:
            means.append((parent_customers, parent_tables))
            samples += 1
            for u, w in wanted:
                own = rooms.get((u, w), [])
                back = (strength + discount * tables[u]) * parent_p(w)
                wanted[u, w] += (sum(own) - discount * len(own) + back) / (strength + of_context[u])
    scores = [sum(math.log10(wanted[pair] / samples) for pair in pairs_of(text)) for text in asked]
    return [sum(x) / len(means) for x in zip(*means, strict=True)], scores


def test_tables_and_scores_as_of_a_plain_gibbs_sampler(docs_of, buckets, monkeypatch):
    """Frequent words after a common context have many tables, not one and a few more; probabilities follow."""
    monkeypatch.setattr(lm, "SAMPLES", 6)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) ** 1.5 for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, weights, k=60))) for i in range(80)]
    asked = [" ".join(rng.choices(words, weights, k=60)) for _ in range(20)] + ["w0 unseen w1", "unseen"]
    model = lm.fit(docs_of(*rows, *((1000 + i, t) for i, t in enumerate(asked))), F.col("doc_id") >= 1000)
    first = model.samples[0]
    want, scores = plain_gibbs(rows, first.discount, first.parent_discount, 100, 20, 1, asked)
    got = [sum(x) / len(model.samples) for x in zip(*((t.parent_customers, t.parent_tables) for t in model.samples), strict=True)]
    assert got == pytest.approx(want, rel=0.1), (got, want)
    found = {r.doc_id: r.score for r in model.scored.collect()}
    assert [found[1000 + i] for i in range(len(asked))] == pytest.approx(scores, rel=0.01)


def test_a_pass_sends_only_what_it_changes(docs_of, monkeypatch):
    """Word codes, tokens and contexts go to the words' homes once; each pass after it tells of tables alone."""
    rng, sent, grouped = random.Random(8), [], lm._grouped

    def seen(rows, *more, **named):
        told = rows.where("kind = 'up'").select("data").collect()
        sent.append(sum(a.nbytes for r in told for a in lm._unpack(r.data)))
        return grouped(rows, *more, **named)

    monkeypatch.setattr(lm, "_grouped", seen)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 1500)
    lm.score(docs_of(*((i, " ".join(f"w{rng.randrange(300)}" for _ in range(50))) for i in range(80))), F.lit(False)).collect()
    first, *later = [n for n in sent if n]
    assert len(later) == lm.STARTS + lm.BURN_IN + lm.SAMPLES
    assert all(0 < n <= first / 3 for n in later), (first, later)
