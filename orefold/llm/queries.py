"""The operators as queries over whole tables, and the SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.llm import sql
from orefold.llm import decontaminate, hard_negatives, licenses, mixing, ngram_join, passages, pii, quality_gam, quality_rules, suffix_dedup, toxicity, vector_codes, wrappers

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, folder, "documents"), ["doc_id"], k=4, percent=85)
    return found.select("doc_id", F.col("j_size").alias("n_shingles"), F.col("j_component").alias("component_id"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    text = wrappers.extract(table(spark, folder, "pages"), ["page_id", "url"])
    return text.select("page_id", "url", F.col("w_text").alias("text"), F.length("w_text").cast("long").alias("n_chars"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.pii_spans(table(spark, folder, "documents"), [F.col("doc_id")], F.col("text"))
    spans = F.col("pii")
    base = F.filter(spans, lambda s: s["kind"].isin(*pii.BASE))
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"), pii.joined(spans).alias("spans"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.hits(table(spark, folder, "documents"), ["doc_id"], "text", table(spark, folder, "benchmark"))
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id",
        F.col("d_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("d_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("d_items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_gam.fit(docs, table(spark, folder, "labels"))
    scores = quality_gam.scored(docs, model, [F.col("doc_id")], F.col("text"))
    score = F.col("g_score")
    return scores.select("doc_id", quality_gam.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality_rules.quality_rules(docs, labels, ["doc_id"]).select("row.doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    key = mixing.row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    mix = mixing.mixture(docs, mixing.word_count(F.col("text")), F.col("source"), key, [F.col("doc_id")])
    return mix.select(
        "doc_id",
        F.col("m_size").alias("size"),
        F.col("m_total").alias("source_size"),
        F.col("m_target").alias("target"),
        (F.col("m_copies") * F.col("m_size")).cast("long").alias("taken"),
    )


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.labelled(table(spark, folder, "documents"), ["doc_id"])


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"), ["doc_id"])


def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, folder, "documents"), ["doc_id"])


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scores = toxicity.scored(docs, model, [F.col("doc_id")], F.col("text"))
    score = F.col("x_score")
    return scores.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    coded = vector_codes.compressed(rows, [F.col("vec_id")], F.col("embedding"), F.col("vec_id"), F.col("label"))
    names = {"v_code": "code", "v_error": "error", "v_label_error": "label_error", "v_books": "codebooks_sha256"}
    return coded.select("vec_id", *[F.col(a).alias(b) for a, b in names.items()])


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mined(table(spark, folder, "embeddings"), vec_id, moved, F.col("embedding"), vec_id % 100 == 0)


QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_ngram_join": (op1_ngram_join, None),
    "op2_html_extraction": (op2_html_extraction, None),
    "op3_pii": (op3_pii, None),
    "op4_decontamination": (op4_decontamination, None),
    "op5_quality_classifier": (op5_quality_classifier, None),
    "op6_quality_rules": (op6_quality_rules, None),
    "op7_mixing": (op7_mixing, None),
    "op8_licenses": (op8_licenses, None),
    "op9_substring_dedup": (op9_substring_dedup, None),
    "op10_suffix_array_dedup": (op10_suffix_array_dedup, None),
    "op11_toxicity": (op11_toxicity, None),
    "op12_vector_codes": (op12_vector_codes, sql.VECTOR_CODES),
    "op13_hard_negatives": (op13_hard_negatives, sql.HARD_NEGATIVES),
}
