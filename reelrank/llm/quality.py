"""Quality rules by host: rule failures summed by domain, shrunk with an empirical beta prior, joined back.

Each document gets its rule counts in one pass (no shuffle) and is judged by
the base rules and by three rules of degree (``RULES``): the share of symbols,
the share of repeated lines, the mean length of words.  Failures of each rule
are counted per domain with partial aggregation, so a domain that holds a
third of all documents costs one row per task.  A domain's failure rate of a
rule is shrunk towards the corpus: the rule's beta prior has the mean and
variance of the domains' rates (method of moments).

A document goes if it fails the base rules; if it fails a rule of degree and
its domain's shrunk rate of that rule is at least ``own_least`` (a single odd
document of an otherwise spotless domain is let pass); or if its domain's
shrunk rate of any rule is over ``host_limit``, whatever the document is like.

Defined results: a null text is empty (no words, fails); a null domain is the
domain ``''``; repeated rows are judged one by one; an empty table gives no
rows; when all domains have one rate of a rule, its prior weighs
``least_weight`` documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.llm import words as W
from reelrank.llm.tables import stored, unused

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
HOST_LIMIT = 0.5
LEAST_WEIGHT = 1.0
OWN_LEAST = 0.01
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ALL_COUNTS = (*COUNTS, "n_lines")
MAX_SYMBOL_PERCENT = 10  # of the characters in words
MAX_DUP_LINE_PERCENT = 50  # of the lines with a word
WORD_LENGTHS = (3, 10)  # mean characters of a word

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))


def line_counts(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines), len(lines) - len(set(lines))


def text_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of :data:`ALL_COUNTS` for each text."""
    out = {k: np.zeros(len(texts), dtype=np.int64) for k in ALL_COUNTS}
    for a, b in W.chunks(texts):
        w = W.Words(texts[a:b])
        n = np.diff(w.bounds)
        out["n_words"][a:b] = n
        points = np.concatenate(([0], np.cumsum((w.bytes & 0xC0) != 0x80)))
        length = np.concatenate(([0], np.cumsum(points[w.ends] - points[w.starts])))
        out["word_chars"][a:b] = np.diff(length[w.bounds])
        symbols = np.concatenate(([0], np.cumsum(_SYMBOL[w.bytes])))
        out["n_symbols"][a:b] = np.diff(symbols[w.offsets])
        lines = np.array([line_counts(t) for t in texts[a:b]], dtype=np.int64).reshape(-1, 2)
        out["n_lines"][a:b], out["n_dup_lines"][a:b] = lines[:, 0], lines[:, 1]
        at = w.windows(WINDOW)
        if len(at):
            owner = np.repeat(np.arange(b - a), n)
            h = W.rolled(w.hashes(W.HASHES[0]), WINDOW, W.HASHES[0])[at]
            key = W.mix(h + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            twice = np.zeros(len(key), dtype=bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            inside = W.covered(at[twice], WINDOW, len(w))
            out["n_repeat_words"][a:b] = np.bincount(owner[inside], minlength=b - a)
    return out


def document_counts(docs: DataFrame, text: str = "text", to: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with the columns of :data:`ALL_COUNTS` added, under the names in ``to``; no shuffle.

    Name the columns apart with ``to`` where ``docs`` has such columns already.
    """
    names = {k: (to or {}).get(k, k) for k in ALL_COUNTS}
    schema = T.StructType([*docs.schema.fields, *[T.StructField(x, T.LongType()) for x in names.values()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_counts(W.encoded(batch.column(batch.schema.get_field_index(text))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(found[k]) for k in ALL_COUNTS]],
                names=[*batch.schema.names, *names.values()])

    return docs.mapInArrow(run, schema)


def base_failed(n_words: Column, n_repeat_words: Column, min_words: int = MIN_WORDS,
                max_repeat_percent: int = MAX_REPEAT_PERCENT) -> Column:
    return (n_words < min_words) | (100 * n_repeat_words > max_repeat_percent * n_words)


#: Rules of degree: name to failure, from the columns of the counts.
RULES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "symbols": lambda c: 100 * c("n_symbols") > MAX_SYMBOL_PERCENT * c("word_chars"),
    "lines": lambda c: 100 * c("n_dup_lines") > MAX_DUP_LINE_PERCENT * c("n_lines"),
    "lengths": lambda c: (c("word_chars") < WORD_LENGTHS[0] * c("n_words")) | (c("word_chars") > WORD_LENGTHS[1] * c("n_words")),
}
FAILED = ("base", *RULES)


def failures(count: Callable[[str], Column]) -> Column:
    """One struct with the failure of the base rules and of each rule of degree."""
    return F.struct(base_failed(count("n_words"), count("n_repeat_words")).alias("base"),
                    *[rule(count).alias(name) for name, rule in RULES.items()])


def host_verdicts(judged: DataFrame, domain: str, failed: str, limit: float = HOST_LIMIT,
                  least_weight: float = LEAST_WEIGHT, own_least: float = OWN_LEAST) -> DataFrame:
    """One row per domain: documents, shrunk failure ``rates`` by rule, whether the domain is kept, and for each rule of
    degree whether a document of the domain that fails it goes (``decides``).

    Only the mean and variance of the domains' rates go to the driver, two numbers for each rule.
    """
    hosts = judged.groupBy(F.coalesce(F.col(domain), F.lit("")).alias("domain")).agg(
        F.count("*").alias("n"), *[F.sum(F.col(failed)[r].cast("long")).alias(f"f_{r}") for r in FAILED])
    moments = hosts.agg(*[f(F.col(f"f_{r}") / F.col("n")) for r in FAILED for f in (F.avg, F.var_pop)]).first()
    rates = []
    for i, r in enumerate(FAILED):
        m, v = moments[2 * i] or 0.0, moments[2 * i + 1] or 0.0
        weight = max(least_weight, m * (1 - m) / v - 1) if v > 0 else least_weight
        rates.append(((F.col(f"f_{r}") + F.lit(weight * m)) / (F.col("n") + F.lit(weight))).alias(r))
    hosts = hosts.select("domain", "n", F.struct(*rates).alias("rates"))
    kept = reduce(Column.__and__, [F.col("rates")[r] <= limit for r in FAILED])
    decides = F.struct(*[(F.col("rates")[r] >= own_least).alias(r) for r in RULES])
    return hosts.select("domain", "n", "rates", kept.alias("host_kept"), decides.alias("decides"))


def verdict(failed: Column, host_kept: Column, decides: Column) -> Column:
    """Whether a document stays, by its own failures and its domain's rates."""
    return reduce(Column.__and__, [~(failed[r] & decides[r]) for r in RULES], ~failed["base"] & host_kept)


def judge(docs: DataFrame, text: str = "text", domain: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Every row of ``docs`` without its text, with the counts, ``base_failed``, ``host_kept`` and ``kept``."""
    drop = {text, *ALL_COUNTS, "base_failed", "host_kept", "kept"} - {domain}
    rest = [c for c in docs.columns if c not in drop]
    to = {k: unused(docs, k) for k in ALL_COUNTS}
    key, failed, decides = (unused(docs, x) for x in ("domain_key", "failed", "decides"))
    counted = document_counts(docs.select(*dict.fromkeys([*rest, domain, text])), text, to).select(
        *rest, *[F.col(to[k]).alias(k) for k in ALL_COUNTS])
    judged = stored(counted.withColumn(failed, failures(F.col)), "quality")
    hosts = host_verdicts(judged, domain, failed, limit).select(F.col("domain").alias(key), "host_kept", F.col("decides").alias(decides))
    return (judged.withColumn(key, F.coalesce(F.col(domain), F.lit(""))).join(hosts, key)
            .withColumn("base_failed", F.col(failed)["base"])
            .withColumn("kept", verdict(F.col(failed), F.col("host_kept"), F.col(decides))).drop(key, failed, decides))


def keep_good(docs: DataFrame, text: str = "text", domain: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs``, with their columns, that the rules and the host verdicts keep.

    The texts are read twice and shuffled never: once for the domains' rates, once to filter.
    """
    to = {k: unused(docs, k) for k in ALL_COUNTS}
    failed, key, kept, decides = (unused(docs, x) for x in ("failed", "domain_key", "host_kept", "decides"))
    own = failures(lambda k: F.col(to[k])).alias(failed)
    few = document_counts(docs.select(*dict.fromkeys([domain, text])), text, to)
    hosts = host_verdicts(stored(few.select(domain, own), "quality"), domain, failed, limit)
    rows = document_counts(docs, text, to).withColumn(failed, own).where(~F.col(failed)["base"])
    rows = rows.withColumn(key, F.coalesce(F.col(domain), F.lit("")))
    return (rows.join(hosts.select(F.col("domain").alias(key), F.col("host_kept").alias(kept), F.col("decides").alias(decides)), key)
            .where(verdict(F.col(failed), F.col(kept), F.col(decides))).select(*[F.col(f"`{c}`") for c in docs.columns]))
