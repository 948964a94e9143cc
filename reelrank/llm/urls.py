"""URL filter: host and path rules, else logistic regression on hashed character n-grams of host and path.

The model is trained on the driver on a small labelled URL table, by default
the one kept with the package, at most ``max_rows`` of it (the first by a hash
of the url, so the choice does not depend on the order of rows).  So a url's
verdict does not depend on the pages judged with it.  Scoring hashes the n-grams of a whole batch of
urls with array arithmetic and adds up weights; rules are column expressions.
No shuffle but the top-``max_rows`` of the labelled table.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and gets the model's verdict on nothing (its bias, which
allows); repeated rows get equal verdicts; with no labelled row, or rows of one
class, the model allows all; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.llm import words as W
from reelrank.llm.tables import shipped
from reelrank.llm.url_table import ALLOW, BLOCK

NGRAMS = (3, 4, 5)
BITS = 18
MAX_ROWS = 4000
STEPS = 1500
RATE = 10.0
BAD_SHARE = 0.3  # weight of the urls to block in training: most urls of a crawl are to be allowed
PENALTY = 1e-5
_DIGITS = bytes(48 if 48 <= c <= 57 else c for c in range(256))  # numbers in a url say nothing of it

# (verdict, host, path) of the rules; a rule's name is its host and path
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, whole, i), F.lit(""))
    return F.translate(part(1), ascii_uppercase, ascii_lowercase), part(2)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (null without one)."""
    name = verdict = F.lit(None).cast("string")
    for what, suffix, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # the last wins
        fits = ((host == suffix) | host.endswith(f".{suffix}")) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(suffix + start)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def features(hosts: list[bytes], paths: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` of every hashed n-gram of ``^host$`` and ``^path$``; host and path grams differ, digits do not."""
    rows, found = [], []
    for part, texts in enumerate((hosts, paths)):
        texts = [b"^" + t.translate(_DIGITS) + b"$" for t in texts]
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        letters = W.mix(np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint64) + np.uint64(1 + 256 * part))
        for n in NGRAMS:
            if len(letters) >= n:
                h = W.rolled(letters, n, W.HASHES[0])
                at = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1:])
                rows.append(owner[at])
                found.append((W.mix(h[at] + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int64))
    join = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
    return join(rows), join(found)


class Model:
    """Weights of the n-grams; a url's n-grams count for their mean, so length does not matter."""

    def __init__(self, bits: int = BITS):
        self.bits, self.weights, self.bias = bits, np.zeros(1 << bits), -1.0

    def scores(self, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
        row, f = features(hosts, paths, self.bits)
        n = np.maximum(np.bincount(row, minlength=len(hosts)), 1)
        return self.bias + np.bincount(row, self.weights[f], minlength=len(hosts)) / np.sqrt(n)

    def fit(self, hosts: list[bytes], paths: list[bytes], labels: np.ndarray, steps: int = STEPS, rate: float = RATE,
            penalty: float = PENALTY) -> Model:
        """Full-batch gradient descent on the mean log loss, each class with its share of the weight."""
        bad = int(labels.sum())
        if not 0 < bad < len(labels):
            return self
        share = np.where(labels > 0, BAD_SHARE / bad, (1 - BAD_SHARE) / (len(labels) - bad))
        row, f = features(hosts, paths, self.bits)
        used, f = np.unique(f, return_inverse=True)  # other weights stay zero
        each = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(hosts)), 1))
        weights, self.bias = np.zeros(len(used)), 0.0
        for _ in range(steps):
            s = self.bias + np.bincount(row, weights[f], minlength=len(hosts)) * each
            error = (labels - 1 / (1 + np.exp(-s))) * share
            weights += rate * (np.bincount(f, (error * each)[row], minlength=len(used)) - penalty * weights)
            self.bias += rate * error.sum()
        self.weights[used] = weights
        return self


def known_urls(spark: SparkSession) -> DataFrame:
    """The labelled URL table ``(url, label)`` of the package: 1 for urls to block."""
    return spark.createDataFrame([*((u, 1) for u in BLOCK), *((u, 0) for u in ALLOW)], "url string, label int")


def train(labelled: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model of at most ``max_rows`` rows of a labelled table ``(url, label)``, all of them if it has no more."""
    host, path = host_and_path(F.col("url"))
    rows = (labelled.distinct().select(host.alias("host"), path.alias("path"), "label", F.xxhash64("url").alias("order"), "url")
            .orderBy("order", "url", "label").limit(max_rows).collect())
    return Model().fit([r.host.encode() for r in rows], [r.path.encode() for r in rows], np.array([r.label for r in rows], dtype=float))


def judge(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, score, verdict`` of every row: a rule's verdict, else the model's."""
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    schema = T.StructType([*parts.schema.fields, T.StructField("score", T.DoubleType())])
    shared = shipped(pages.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in batches:
            found = model.scores(W.encoded(batch.column(1)), W.encoded(batch.column(2)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=schema.names)

    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return parts.mapInArrow(run, schema).select(
        "page_id", "host", "path", name.alias("rule"), "score",
        F.coalesce(verdict, F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"))
