"""Language identification by multilingual mixture inference.

A document may mix languages. Its character trigrams are taken as drawn from a mixture of the learned languages'
trigram distributions; expectation-maximisation estimates the document's language proportions, and the set of
languages is chosen by a penalised likelihood: starting with the best single language, one more is let in only
while it raises the log likelihood by more than the penalty (half a log of the trigram count for the extra
proportion, and a margin for each trigram's noise). The prediction is the language with the largest proportion.

Learning counts hashed trigrams per language over all training rows, in Spark. The model has a fixed number of
buckets per language, so what is sent to the tasks depends on the number of languages only.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import arrow_rows

BUCKETS = 1 << 15
SMOOTHING = 0.5
ROUNDS = 12
#: Gain in log likelihood asked of a further language: this share of the trigrams, besides half a log of their count.
MARGIN = 0.02
BATCH = 256
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Learned languages in alphabetical order, and log probability (bucket, language)."""

    languages: list[str]
    log_p: np.ndarray


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each letter's trigram: the letter, lower-cased, with what stands on either side.

    Whatever is not a letter counts as one blank, so digits, symbols and layout tell nothing.
    """
    parts = [np.frombuffer(f" {t or ''} ".lower().encode("utf-32-le", "replace"), dtype=np.uint32) for t in texts]
    docs = np.repeat(np.arange(len(parts), dtype=np.int64), [len(p) for p in parts])
    points = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    points = np.where(_letters()[points], points, 0).astype(np.uint64)
    middle = np.flatnonzero(points)  # each text is framed by blanks, so a letter has neighbours
    mixed = points[middle - 1] * np.uint64(0x9E3779B97F4A7C15) ^ points[middle] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ points[middle + 1] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
    return docs[middle], (mixed >> np.uint64(64 - 15)).astype(np.int64)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.diff(np.append(starts, len(keys)))


def learn(docs: DataFrame) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of all given rows; rows with a null in either teach nothing.

    The model is one number per (language, bucket), brought to the driver: its size is bounded by the number of
    distinct languages, whatever the number of documents. No training row at all gives a model without languages.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in arrow_rows(batches, BATCH):
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text").to_pylist()
            for lang in set(langs):
                _, buckets = trigrams([t for t, own in zip(texts, langs, strict=True) if own == lang])
                totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                totals[lang] += np.bincount(buckets, minlength=BUCKETS)
        for lang, found in totals.items():
            used = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(used), pa.string()), "bucket": pa.array(used, pa.int64()), "n": pa.array(found[used], pa.int64())})

    taught = docs.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = taught.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    names = np.array(table.column("lang").to_pylist(), dtype=object)
    languages = sorted(set(names.tolist()))
    totals = np.zeros((BUCKETS, len(languages)))
    place = {x: i for i, x in enumerate(languages)}
    totals[table.column("bucket").to_numpy(), [place[x] for x in names]] = table.column("n").to_numpy()
    return LanguageModel(languages, np.log((totals + SMOOTHING) / (totals.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32))


def mixture(log_p: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions and log likelihood of ``counts`` trigrams with per-language ``log_p`` (trigram, language), by EM."""
    peak = log_p.max(axis=1, keepdims=True)
    p = np.exp(log_p - peak)
    share = np.full(p.shape[1], 1.0 / p.shape[1])
    for _ in range(rounds if p.shape[1] > 1 else 0):
        each = p * share
        share = counts @ (each / each.sum(axis=1, keepdims=True)) / counts.sum()
    return share, float(counts @ (np.log(p @ share) + peak[:, 0]))


def infer(model: LanguageModel, buckets: np.ndarray, counts: np.ndarray) -> tuple[dict[str, float], float]:
    """The chosen languages with their proportions, and the log likelihood."""
    log_p, total = model.log_p[buckets], int(counts.sum())
    penalty = 0.5 * np.log(max(total, 2)) + MARGIN * total
    single = counts @ log_p
    chosen = [int(np.argmax(single))]
    share, best = np.ones(1), float(single[chosen[0]])
    # no set can reach more than each trigram's best language gives
    while len(chosen) < len(model.languages) and float(counts @ log_p.max(axis=1)) - best > penalty:
        tried = [(mixture(log_p[:, [*chosen, x]], counts), x) for x in range(len(model.languages)) if x not in chosen]
        (new_share, found), x = max(tried, key=lambda t: t[0][1])
        if found - best <= penalty:
            break
        chosen, share, best = [*chosen, x], new_share, found
    return {model.languages[x]: float(s) for x, s in zip(chosen, share, strict=True)}, best


def identify(docs: DataFrame, model: LanguageModel, *keep: str | Column, with_text: bool = False) -> DataFrame:
    """``keep`` columns and ``lang_pred``, ``score``, ``languages`` (map of proportions) for every row of ``docs``.

    With ``with_text`` the text comes back as ``__text``, so that it travels once.

    Texts that are null or have no letter, and all texts under an empty model, get 'und' with score 0. The score is
    the proportion of the predicted language in the chosen mixture. Ties go to the first language by name.
    """
    out = docs.select(*keep).limit(0)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            n, found = len(texts), [{} for _ in texts]
            if model.languages and n:
                doc, bucket = trigrams(texts)
                keys, counts = _counted(doc * BUCKETS + bucket)
                ends = np.searchsorted(keys, np.arange(n + 1) * BUCKETS)
                for i in range(n):
                    own = slice(ends[i], ends[i + 1])
                    if ends[i] < ends[i + 1]:
                        found[i] = infer(model, keys[own] % BUCKETS, counts[own].astype(np.float64))[0]
            best = [max(sorted(x), key=x.get) if x else UNKNOWN for x in found]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(best, pa.string()), pa.array([min(1.0, x.get(b, 0.0)) for x, b in zip(found, best, strict=True)], pa.float64())]
            columns.append(pa.array([list(x.items()) for x in found], pa.map_(pa.string(), pa.float64())))
            names = [*batch.schema.names[:-1], "lang_pred", "score", "languages"]
            if with_text:
                columns, names = [*columns, batch.column(batch.num_columns - 1)], [*names, "__text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    # the text goes last under a name of its own, so that no kept column can clash with it
    given = docs.select(*keep, F.col("text").alias("__text"))
    return given.mapInArrow(work, f"{fields}, lang_pred string, score double, languages map<string,double>" + ", __text string" * with_text)
