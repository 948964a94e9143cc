"""SimHash near duplicates: fingerprints, pigeonhole blocks, exact Hamming check, connected components.

Documents with one fingerprint form one class, so a group of identical copies
is one row however large.  A fingerprint is cut into four 16-bit blocks; two
fingerprints that differ in at most two bits agree on at least two blocks, so
they meet under one of the six pairs of blocks (32 equal bits).  Members of a
meeting place are joined and their Hamming distance is checked.  A crowded
meeting place (more than ``crowd`` fingerprints, e.g. thousands of near
copies) is not joined pair by pair: its members differ only in the other 32
bits, and two of them are within two bits exactly if they share a value within
one bit of each.  So every member is listed under its value and its 32 one-bit
neighbours (at most 33 fingerprints meet there), and each links to the first
one there, its distance checked like any other.  No link is lost and none is added between parts that
no chain of links joins.

Components come from alternating large-star and small-star rounds; each
round's links are written to the shared folder.  Labels are the smallest
document ids.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; repeated rows give repeated result rows; a row without an id gets
the component of its fingerprint (null if no row there has an id); an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.llm import words as W
from reelrank.llm.tables import stored, unused

SHINGLE = 3
MAX_BITS = 2
SEED = 42
CROWD = 64
_STEP = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text: a bit is set if over half of the hashes have it."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    flat, first, spans = b" ".join(words), 0, []
    ends, at = [], -1
    for x in words:
        at += len(x) + 1
        ends.append(at)
    for k in range(n):
        spans.append((first, ends[min(k + shingle, len(words)) - 1]))
        first = ends[k] + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for a in range(0, n, _STEP):
        part = np.array([digest(flat[s:e], SEED) for s, e in spans[a:a + _STEP]], dtype=">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", to: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the text, with the fingerprint as a signed long in column ``to``; no shuffle."""
    rest = [c for c in docs.columns if c != text]
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in rest]).schema.fields, T.StructField(to, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.encoded(batch.column(batch.schema.get_field_index(text)))
            fp = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            kept = [i for i, x in enumerate(batch.schema.names) if x != text]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(fp)], names=[*rest, to])

    return docs.mapInArrow(run, schema)


def _blocks(fp, pair: tuple[int, int]):
    """The two 16-bit blocks of a pair, as one 32-bit key."""
    i, j = pair
    part = lambda k: F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))
    return F.shiftleft(part(i), 16).bitwiseOR(part(j))


def _apart(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def near_pairs(classes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints of column ``fp`` at most two bits apart.

    In places that are not crowded every such pair is a link; in a crowded
    place the links join the same fingerprints through chains of such pairs.
    """
    pairs = list(combinations(range(4), 2))
    places = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("which"), _blocks(F.col("fp"), p).alias("key")) for k, p in enumerate(pairs)
    ])).alias("place")).select("fp", "place.*")
    size = places.groupBy("which", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(places.join(size, ["which", "key"]), "simhash-places")
    few = met.where(F.col("n") <= crowd)
    plain = (few.select("which", "key", F.col("fp").alias("a"))
             .join(few.select("which", "key", F.col("fp").alias("b")), ["which", "key"])
             .where((F.col("a") < F.col("b")) & (_apart("a", "b") <= MAX_BITS)).select("a", "b"))
    free = F.array(*[  # the bits that members of a place may differ in
        F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), 16 * k + i)
                for k in range(4) if k not in p for i in range(16)]) for p in pairs])
    listed = met.where(F.col("n") > crowd).select(
        "which", "key", "fp", F.explode(F.element_at(free, F.col("which") + 1)).alias("flip")).select(
        "which", "key", F.col("fp").bitwiseXOR(F.col("flip")).alias("near"), "fp")
    first = (listed.groupBy("which", "key", "near").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
             .where(F.size("fps") > 1))  # at most 33 fingerprints
    starred = (first.select(F.col("fps")[0].alias("a"), F.explode("fps").alias("b"))
               .where((F.col("a") < F.col("b")) & (_apart("a", "b") <= MAX_BITS)))
    return plain.unionByName(starred).distinct()


def components(links: DataFrame, name: str = "links", rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node in ``links (a, b)``: rows ``(node, root)``.

    Alternates large-star and small-star until the links no longer change.
    Only a count and a checksum of a round go to the driver.
    """
    both = lambda d: d.select("a", "b").unionByName(d.select(F.col("b").alias("a"), F.col("a").alias("b")))
    mark = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def star(edges: DataFrame, low: DataFrame) -> DataFrame:
        return edges.join(low, "a").where(F.col("b") != F.col("least")).select(
            F.col("b").alias("a"), F.col("least").alias("b")).distinct()

    current = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .where("a != b").distinct(), name)
    seen = mark(current)
    for _ in range(rounds):
        wide = both(current)
        least = wide.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        down = star(wide.where(F.col("b") > F.col("a")), least)  # each larger neighbour to the least one
        low = down.groupBy("a").agg(F.min("b").alias("least"))
        small = star(down, low).unionByName(low.select("a", F.col("least").alias("b")))
        current = stored(small.distinct(), name)
        now = mark(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components: links still change after {rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
          crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    prints = stored(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                                 "text", "fp", shingle), "simhash-fp")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    return _labelled(prints, classes, near_pairs(classes, crowd))


def _rooted(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the ``root`` of each fingerprint: fingerprints are the nodes of the components."""
    roots = components(links, "simhash-links")
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def _labelled(prints: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    of = _rooted(classes, links)
    ids = of.groupBy("root").agg(F.min("least").alias("component_id"))  # the smallest id of a component is its label
    label = of.join(ids, "root").select("fp", "component_id")
    return prints.join(label, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def row_key(docs: DataFrame) -> Column:
    """128 bits of a row's values, nulls told from empty ones: equal for equal rows only."""
    values = [*(F.col(f"`{c}`") for c in docs.columns), *(F.col(f"`{c}`").isNull() for c in docs.columns)]
    return F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit("again"), *values).alias("b"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               crowd: int = CROWD) -> DataFrame:
    """Exactly one row of ``docs`` of every component of its rows: the one of the smallest id.

    Rows of one id may have different texts and are judged each by its own.  Of a component's rows with one id the
    one of the smaller hash of its values stays; rows without an id come after all that have one; of rows equal in
    every column one stays.
    """
    key = unused(docs, "key")
    rows = docs.select(row_key(docs).alias("key"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = stored(fingerprints(rows, "text", "fp", shingle), "simhash-fp")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    classes = stored(prints.groupBy("fp").agg(F.min(order).alias("first")), "simhash-classes")
    of = stored(_rooted(classes, near_pairs(classes.select("fp"), crowd)), "simhash-roots")
    winner = of.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.key").alias("key"))
    # every distinct row of the table, how often it comes, and whether it stays
    counts = prints.groupBy("key").agg(F.count("*").alias("n"))
    ids = stored(counts.join(winner.withColumn("stays", F.lit(True)), "key", "left"), "simhash-ids")
    # hashed by shuffle at every size: what goes grows with the corpus, so it is never broadcast, and the texts,
    # which this deals out once, need no sort
    gone = ids.where("stays IS NULL").select(F.col("key").alias(key)).hint("shuffle_hash")
    kept = docs.withColumn(key, row_key(docs)).join(gone, key, "left_anti")
    again = ids.where("stays AND n > 1").select(F.col("key").alias(key)).hint("shuffle_hash")
    if not again.isEmpty():
        kept = kept.join(again, key, "left_anti").unionByName(kept.join(again, key, "left_semi").dropDuplicates([key]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
