from __future__ import annotations

import random

import numpy as np
from ledgerline.llm import langid
from pyspark.sql import functions as F

SYLLABLES = {"aa": ["ka", "to", "ri", "mu"], "bb": ["str", "ent", "ung", "ich"], "cc": ["é", "que", "oi", "eau"]}


def text(lang, rng, words=60):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(words))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string, text_ string")


def test_held_out_accuracy_and_mixtures(spark):
    rng = random.Random(5)
    train = [(i, text(lang, rng), lang, "s", "t") for i, lang in enumerate(list(SYLLABLES) * 10)] + [(90, None, "aa", "", ""), (91, "ka", None, "", "")]
    model = langid.learn(frame(spark, train))
    assert model.languages == sorted(SYLLABLES)
    asked = [(i, text(lang, rng, 30), lang, "s", "t") for i, lang in enumerate(list(SYLLABLES) * 5)]
    mixed = text("aa", rng, 70) + "\n" + text("bb", rng, 20)
    asked += [(50, mixed, "aa", "s", "t"), (51, None, "", "", ""), (52, "12 !? 3", "", "", ""), (53, "", "", "", ""), (54, "ka " * 40_000, "", "", "")]
    got = langid.identify(frame(spark, asked), model, "doc_id", "lang", F.col("score").alias("kept"))
    rows = {r.doc_id: r for r in got.collect()}
    assert got.columns == ["doc_id", "lang", "kept", "lang_pred", "score", "languages"]
    assert all(rows[i].lang_pred == rows[i].lang for i in range(15))
    assert set(rows[50].languages) == {"aa", "bb"} and rows[50].lang_pred == "aa" and 0.5 < rows[50].score < 1
    assert all((rows[i].lang_pred, rows[i].score) == ("und", 0.0) for i in (51, 52, 53))
    assert rows[54].lang_pred == "aa"


def test_nothing_to_learn_from(spark):
    model = langid.learn(frame(spark, []))
    got = langid.identify(frame(spark, [(1, "abc", "x", "", "")]), model, "doc_id").first()
    assert model.languages == [] and (got.lang_pred, got.score) == ("und", 0.0)
    assert langid.identify(frame(spark, []), model, "doc_id").count() == 0


def test_em_finds_the_proportions():
    log_p = np.log(np.array([[0.9, 0.1], [0.1, 0.9]], np.float32))
    share, _ = langid.mixture(log_p, np.array([700.0, 300.0]), rounds=200)
    assert abs(share[0] - 0.75) < 0.02  # 0.9 s + 0.1 (1 - s) = 0.7


def test_each_letter_is_the_middle_of_one_trigram():
    docs, buckets = langid.trigrams(["ab c1d", None, "", "Éa"])
    assert np.bincount(docs, minlength=4).tolist() == [4, 0, 0, 2]
    assert langid.trigrams(["éA"])[1].tolist() == langid.trigrams(["Éa"])[1].tolist()
