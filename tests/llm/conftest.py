from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, n int, tree string, score double"


@pytest.fixture
def docs_of(spark):
    """Documents with columns whose names the operators use themselves."""

    def make(*rows):
        return spark.createDataFrame([(i, t, "en", 1, "x", 0.5) for i, t in rows], SCHEMA)

    return make


@pytest.fixture
def corpus():
    """Copies, near copies, shared passages, short, empty and null texts, a repeated row and null ids."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=rng.randrange(20, 90))) for _ in range(12)]
    shared = " ".join(rng.choices(words, k=60))
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(40):
        tokens = rng.choice(base).split()
        for _ in range(rng.randrange(4)):
            tokens[rng.randrange(len(tokens))] = rng.choice(words)
        rows.append((100 + i, " ".join(tokens)))
    for i in range(6):
        own = rng.choices(words, k=10)
        rows.append((200 + i, " ".join(own) + "\n" + shared + "\n" + " ".join(reversed(own))))
    rows += [(300, None), (301, ""), (302, " \t\n "), (303, "one two"), (304, "ONE two"), (305, "é È é È é È é È é")]
    rows += [(306, "again " * 200), (307, base[0]), (307, base[0]), (308, base[1].upper()), (None, base[2]), (None, None)]
    return rows
