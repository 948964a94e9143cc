"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import bpe, centroids, html, leaks, licences, negatives, packing, pii, quality, shards, simhash, substrings, urls
from reelrank.llm.oracle import ORACLE
from reelrank.llm.tables import read

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}

__all__ = ["ORACLE", "QUERIES"]


def register(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


def byte_bpe() -> bpe.Vocabulary:
    """The byte-level vocabulary of the token query; its file is found where it is installed."""
    import public_tokenizers

    return bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op1_url_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    pages = read(spark, sf_dir, "pages")
    return urls.judge(pages, urls.train(urls.known_urls(spark))).select("page_id", "host", "path", "rule", "verdict")


@register
def op2_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).withColumn("n_chars", F.char_length("text").cast("long"))


@register
def op3_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 of near equal bytes; equal texts share a shard."""
    return shards.assign(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@register
def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.group(read(spark, sf_dir, "documents"))


@register
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in every document once repeated 20-word windows are gone."""
    return substrings.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@register
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it leaks, with the best window."""
    return leaks.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every document, and of the bytes decoded from them."""
    return bpe.round_trip(read(spark, sf_dir, "documents").select("doc_id", "text"), byte_bpe()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict on every document, with its source as domain."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.judge(docs).select("doc_id", *quality.COUNTS, "base_failed", "kept")


@register
def op5_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and digest, and all spans, of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id", *map(count, pii.KINDS),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@register
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own, inherited and effective licence of every document, as a file of its source and language."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = licences.scan(licences.documents_as_files(docs), keep=("doc_id",))
    return found.select("doc_id", "path", "own", F.round("cosine", 6).alias("cosine"), "inherited", "from_dir", "licence")


@register
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and squared distance of every vector of 64 components after three rounds."""
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


def word_bpe() -> str:
    """The tokenizer file of the packing query; found where it is installed."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@register
def op12_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 2048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), word_bpe()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read(spark, sf_dir, "embeddings"), label)
