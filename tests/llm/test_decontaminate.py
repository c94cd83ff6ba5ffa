from __future__ import annotations

import random

from ledgerline.llm import decontaminate as de


def distance(pattern, text):
    """Least edits that turn the pattern into some substring of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_bit_parallel_distance_equals_the_table():
    rng = random.Random(4)
    for _ in range(300):
        pattern = "".join(rng.choices("abcd", k=rng.randrange(1, 90)))
        text = "".join(rng.choices("abcd", k=rng.randrange(0, 120)))
        if rng.random() < 0.5:
            text += pattern[: len(pattern) // 2] + "x" + pattern[len(pattern) // 2 + 1 :] + "dd"
        found, end = de.closest(de.pattern_masks(pattern), len(pattern), text)
        assert found == distance(pattern, text) and distance(pattern, text[:end]) == found


def altered(text, edits, rng):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = "q"
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, "z")
    return "".join(chars)


def test_equals_brute_force(spark, docs_of, monkeypatch):
    rng = random.Random(6)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(2, 25)))) for i in range(12)]
    docs = []
    for i in range(50):
        item = rng.choice(items)[1]
        body = altered(item, rng.randrange(0, len(item) // 10 + 2), rng).replace(" ", rng.choice([" ", "\n", "  "]))
        docs.append((i, " ".join(rng.choices(words, k=15)) + " " + (body.upper() if i % 2 else body) + " end"))
    docs += [(60, None), (61, ""), (62, "x" * 30_000), (None, items[0][1]), (63, items[3][1]), (63, items[3][1])]
    bench = spark.createDataFrame(items + [(None, "alpha"), (90, None), (91, " \n ")], "item_id bigint, text string")
    want = []
    for i, t in docs:
        for item, p in items:
            p = de.normal(p)
            if t and (found := distance(p, de.normal(t))) <= de.budget(len(p)):
                want.append((i, item, found))
    frame = docs_of(*docs)
    key = lambda r: tuple((x is not None, x) for x in r)
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in de.matches(frame, bench).collect()), key=key)
    assert got == sorted(want, key=key)
    monkeypatch.setattr(de, "GROUP_CHARS", 300)
    again = sorted(((r.doc_id, r.item_id, r.distance) for r in de.matches(frame, bench).collect()), key=key)
    assert again == got
    kept = de.clean(frame, bench)
    hit = {i for i, _, _ in want}
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _ in docs if i not in hit), key=str)


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert de.matches(docs_of((1, "a")), bench).count() == 0 and de.clean(docs_of((1, "a")), bench).count() == 1
    assert de.matches(docs_of(), spark.createDataFrame([(1, "a b")], bench.schema)).count() == 0


def test_text_ids_of_items_and_documents(spark):
    bench = spark.createDataFrame([("a", "one two three"), ("b", "four five"), (None, "one")], "item_id string, text string")
    docs = spark.createDataFrame([("x", "say ONE  two three"), ("y", "four"), (None, "four five"), ("z", None)], "doc_id string, text string")
    found = de.matches(docs, bench)
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in found.collect()), key=str) == [("x", "a", 0), (None, "b", 0)]
    assert sorted(r.doc_id for r in de.clean(docs, bench).collect()) == ["y", "z"]
