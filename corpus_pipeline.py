"""A corpus pipeline over ``documents``: five stages, each an operator of ``orefold.llm``.

Every stage takes the rows its predecessor left and returns documents of the same
columns, except the last, which returns what the mix takes of each. ``run`` stores the
result of each stage but the last below ``spark.checkpoint.dir``, so that the next
reads it as often as it needs and a lost executor repeats no stage; a stored result goes
as soon as the next one is stored.

Defined cases: null and empty texts have no words, so the first stage rejects them; a
document labelled twice counts as good if any label says so; rows with equal ids are
judged each by its text, and of near copies with equal ids one row stays; null ids count
as larger than all others; null sources mix as a source of their own; texts of any
length are read whole; an empty table gives no rows; further columns pass through all
stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.llm import decontaminate, mixing, ngram_join, pii, quality_rules
from orefold.llm.scratch import Scratch

# Cutoffs learnt from labels, components of a graph and a random order are not SQL.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules do not reject."""
    return quality_rules.good_documents(docs, _table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8) the smallest id."""
    return ngram_join.one_per_group(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    columns = docs.columns
    found = decontaminate.hits(docs, columns, "text", _table(spark, sf_dir, "benchmark"))
    return found.where(F.size("d_spans") == 0).select(*columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the new text."""
    found = pii.pii_redacted(docs, [F.struct(*docs.columns).alias("row")], F.col("text"))
    text = F.when(F.col("row.text").isNotNull(), F.col("pii_text"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: words, its source's words and target, and words taken into the mix."""
    key = mixing.row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    mix = mixing.mixture(docs, mixing.word_count(F.col("text")), F.col("source"), key, [F.col("doc_id"), F.col("source")])
    return mix.select(
        "doc_id",
        "source",
        F.col("m_size").alias("size"),
        F.col("m_total").alias("source_size"),
        F.col("m_target").alias("target"),
        (F.col("m_copies") * F.col("m_size")).cast("long").alias("taken"),
    )


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", keep_uncontaminated),
    ("PII", hide_personal_data),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``."""
    scratch, stored = Scratch(spark), None
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if stored is not None:
            scratch.drop(stored)
        stored = docs
    return STAGES[-1][1](spark, docs, sf_dir)
