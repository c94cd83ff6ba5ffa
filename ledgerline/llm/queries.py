"""The registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.llm import align, decontaminate, jaccard, langid, lines, lm, packing, pii, quality, resample, simhash, suffix
from ledgerline.llm.common import read_table, remainder
from ledgerline.llm.topk import top_k


def op1_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix.dedup(read_table(spark, sf_dir, "documents"))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return done.select("doc_id", "n_bytes", length.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return packing.place(packing.tokenise(docs, public_tokenizers.path("word_bpe_49k.json")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: one point for quality, one for not being toxic; kept are documents more likely than not to have both."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    grades = labels.select("doc_id", (F.col("quality") + 1 - F.col("toxic")).cast("int").alias("grade"))
    graded = quality.grade(docs, quality.fit(docs, grades, n_grades=3), 2, "doc_id")
    return graded.withColumn("keep", F.col("tail_probability") >= 0.5)


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 1
    return lm.score(docs, held_out)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(read_table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    digest = F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.as_text(F.col("spans")).alias("spans"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    found = langid.identify(docs, langid.learn(docs.where(~held_out)), "doc_id", held_out.alias("held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those removed, and the text that stays."""
    done = lines.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item of which it holds a copy."""
    return decontaminate.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return align.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(read_table(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix": op1_suffix,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_lm": op4_lm,
    "op5_pii": op5_pii,
    "op6_langid": op6_langid,
    "op7_lines": op7_lines,
    "op8_jaccard": op8_jaccard,
    "op9_decontamination": op9_decontamination,
    "op10_topk": op10_topk,
    "op11_align": op11_align,
    "op12_simhash": op12_simhash,
    "op13_resample": op13_resample,
}

ORACLE_SQL: dict[str, str] = {
    "op8_jaccard": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
          FROM documents
        ), sets AS (
          SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
          FROM words
        ), rows_ AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        shared AS (
          SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k, any_value(x.n) AS n, any_value(y.n) AS m
          FROM rows_ x JOIN rows_ y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
        ), links AS (SELECT a, b FROM shared WHERE 100 * k >= 80 * (n + m - k)),
        reach AS (
          SELECT doc_id AS node, doc_id AS other FROM sets
          UNION
          SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
        )
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
        FROM sets s JOIN reach r ON s.doc_id = r.node GROUP BY s.doc_id, s.s
    """,
    "op10_topk": """
        WITH good AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM (SELECT vec_id, min(v) AS v FROM good GROUP BY vec_id) q JOIN good c ON q.vec_id <> c.vec_id
          WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scored
        QUALIFY rank <= 10
    """,
}
