"""The corpus pipeline: quality rules, near duplicates, benchmark leaks, personal data, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that the next
one reads back as its ``docs``.  All but the last keep the columns of the
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import bpe, leaks, pii, quality, simhash
from reelrank.llm.queries import byte_bpe
from reelrank.llm.tables import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, of sources that pass the host rules."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one of the smallest id."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return leaks.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` counts the masked text."""
    masked = pii.mask(docs, pii.train(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else masked


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids of the text, their number, and the text that they decode to."""
    return bpe.round_trip(docs.select("doc_id", "text"), byte_bpe()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("decoded"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: No SQL: fingerprints, the random field and the token merges are beyond it; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
