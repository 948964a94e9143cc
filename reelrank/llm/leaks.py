"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted similarity.

Words are lower-cased runs of letters and digits (ASCII punctuation
separates).  For an item of n words the windows of n words of a document are
compared with it by their shingles of five words; a shingle weighs as many
bytes as its words have.

1. A window and an item without a common shingle have similarity zero, so
   only windows around a shared shingle are looked at, and only for the items
   that have a shingle of the document.  This screen is exact and leaves almost
   nothing of a clean corpus.
2. The window's weighted SimHash is looked up in the index: item fingerprints
   are cut into eight blocks of eight bits, and fingerprints within
   ``radius`` bits agree to within ``radius // 8`` bits on a block at least, so
   the union of the blocks' neighbourhoods has all items within the radius.
   Their Hamming distance is then checked.
3. Weighted multiset Jaccard of the shingles, in whole numbers, decides:
   ``similarity`` or more is a leak.

The index holds at most ``MAX_ITEMS`` items and ``MAX_BYTES`` of their text
(checked); a larger benchmark is written by parts and searched in several
indexes, one pass each.  Windows are looked up in runs of at most ``MAX_CELLS``
windows times items, so memory does not grow with the text.  Documents are
read in place: no shuffle, no join.

Defined results: null or empty texts and items match nothing; an item of fewer
than five words has one shingle, the whole, and matches only equal windows; a
document shorter than an item is one window; repeated rows are judged one by
one; equal items each match; an item without an id matches like any other, with
a null id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.llm import words as W
from reelrank.llm.tables import shipped
from reelrank.session import scratch_path

SHINGLE = 5
SIMILARITY = (4, 5)  # at least 4 / 5
RADIUS = 20
MAX_ITEMS = 4096
MAX_BYTES = 16 << 20
MAX_CELLS = 1 << 21  # windows times items looked up at once
_RUN = 4096  # windows whose bits are summed at once
_SPACED = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))
_NEAR = np.array([[bin(a ^ b).count("1") for b in range(256)] for a in range(256)], dtype=np.uint8)

FOUND = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("start_word", T.LongType()),
    T.StructField("n_words", T.LongType()), T.StructField("bits", T.IntegerType()),
    T.StructField("similarity", T.DoubleType())])


def plain(text: str | None) -> bytes:
    return (text or "").lower().encode(errors="replace").translate(_SPACED)


def prints(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of ``size`` weighted shingles from each of the ``starts``: a bit is set if over half the weight has it."""
    out = np.empty(len(starts), dtype=np.uint64)
    for a in range(0, len(starts), _RUN):
        part = starts[a:a + _RUN]
        low, high = int(part[0]), int(part[-1]) + size
        bits = np.unpackbits(hashes[low:high].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        w = weights[low:high].astype(np.int64)
        sums = np.zeros((high - low + 1, 64), dtype=np.int64)
        np.cumsum(bits * w[:, None], axis=0, out=sums[1:])
        total = np.concatenate(([0], np.cumsum(w)))
        inside = 2 * (sums[part - low + size] - sums[part - low]) > (total[part - low + size] - total[part - low])[:, None]
        out[a:a + _RUN] = np.packbits(inside, axis=1).view(">u8").reshape(-1)
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Weighted multiset Jaccard of two lists of (shingle hashes, weights), as a fraction."""
    weight, both = {}, [{}, {}]
    for counts, (hashes, weights) in zip(both, (a, b)):
        for h, w in zip(hashes.tolist(), weights.tolist()):
            weight[h] = w
            counts[h] = counts.get(h, 0) + 1
    low = sum(w * min(both[0].get(h, 0), both[1].get(h, 0)) for h, w in weight.items())
    return low, sum(w * max(both[0].get(h, 0), both[1].get(h, 0)) for h, w in weight.items())


def _shingles(w: W.Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight of every ``k`` consecutive words (also across texts)."""
    lengths = np.concatenate(([0], np.cumsum(w.ends - w.starts)))
    return W.rolled(hashes, k, W.HASHES[0]), (lengths[k:] - lengths[:-k])[: max(0, len(w) - k + 1)]


class Index:
    """Items of a benchmark by shingle and, for each length, by blocks of their fingerprints."""

    def __init__(self, items: list[tuple[int, str]], radius: int = RADIUS):
        w = W.Words([plain(t) for _, t in items]) if items else W.Words([b""])
        hashes = w.hashes(W.HASHES[0])
        self.radius, self.by_size, self.lengths = radius, {}, {}
        sizes = np.diff(w.bounds)
        for i, (item, _) in enumerate(items):
            n = int(sizes[i])
            if not n:
                continue
            k, at = min(SHINGLE, n), int(w.bounds[i])
            h, weights = _shingles(w, hashes, k)
            own = (h[at:at + n - k + 1], weights[at:at + n - k + 1])
            group = self.lengths.setdefault(n, {"k": k, "ids": [], "fp": [], "own": []})
            group["ids"].append(item)
            group["own"].append(own)
            group["fp"].append(prints(*own, np.zeros(1, dtype=np.int64), len(own[0]))[0])
            for x in set(own[0].tolist()):
                self.by_size.setdefault(k, {}).setdefault(x, {}).setdefault(n, []).append(len(group["ids"]) - 1)
        self.keys = {}
        for k, of in self.by_size.items():
            keys = np.array(sorted(of), dtype=np.uint64)
            likely = np.zeros(1 << 20, dtype=bool)
            likely[keys >> np.uint64(44)] = True
            self.keys[k] = (keys, likely)
        for group in self.lengths.values():
            group["fp"] = np.array(group["fp"], dtype=np.uint64)
            blocks = group["fp"].astype(">u8").view(np.uint8).reshape(-1, 8)
            # near[b][v]: the items whose block b is within radius // 8 bits of v
            group["near"] = [_NEAR[:, blocks[:, b]] <= radius // 8 for b in range(8)]

    def lookup(self, group: dict, fps: np.ndarray, items: np.ndarray | None = None) -> list[tuple[int, int, int]]:
        """``(window, item, bits)`` of the fingerprints of all items (or of ``items``) within the radius of a window's."""
        items = np.arange(len(group["fp"])) if items is None else items
        parts, out = fps.astype(">u8").view(np.uint8).reshape(-1, 8), []
        near, step = [of[:, items] for of in group["near"]], max(1, MAX_CELLS // max(1, len(items)))
        for a in range(0, len(fps), step):
            some = np.zeros((len(fps[a:a + step]), len(items)), dtype=bool)
            for b in range(8):
                some |= near[b][parts[a:a + step, b]]
            window, item = np.nonzero(some)
            bits = np.bitwise_count(fps[a + window] ^ group["fp"][items[item]])
            ok = bits <= self.radius
            out += zip((a + window[ok]).tolist(), items[item[ok]].tolist(), bits[ok].tolist())
        return out

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int, float]]:
        """``(text, item_id, start_word, n_words, bits, similarity)``: the best window of each text and item."""
        out = []
        raw = [plain(t) for t in texts]
        for a, b in W.chunks(raw):
            w = W.Words(raw[a:b])
            hashes = w.hashes(W.HASHES[0])
            owner = np.repeat(np.arange(b - a), np.diff(w.bounds))
            places: dict[tuple[int, int], list[int]] = {}
            shared: dict[tuple[int, int], set[int]] = {}
            of_k = {}
            for k, (keys, likely) in self.keys.items():
                h, weights = of_k[k] = _shingles(w, hashes, k)
                at = np.flatnonzero(likely[h >> np.uint64(44)])
                at = at[(owner[at] == owner[at + k - 1])]
                spot = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
                seen: set[tuple[int, int]] = set()
                for p in at[keys[spot] == h[at]].tolist():
                    i, x = int(owner[p]), int(h[p])
                    for n, items in self.by_size[k][x].items():
                        places.setdefault((i, n), []).append(p)
                        if (i, x) not in seen:
                            shared.setdefault((i, n), set()).update(items)
                    seen.add((i, x))
            for (i, n), hits in sorted(places.items()):
                group, first, last = self.lengths[n], int(w.bounds[i]), int(w.bounds[i + 1])
                k, size = group["k"], min(n, last - first)
                h, weights = of_k[k]
                p = np.array(hits)
                marks = np.zeros(last - first + 1, dtype=np.int64)
                np.add.at(marks, np.maximum(p - (size - k), first) - first, 1)
                np.add.at(marks, np.minimum(p, last - size) - first + 1, -1)
                starts = np.flatnonzero(np.cumsum(marks)[:last - first]) + first
                best: dict[int, tuple] = {}
                asked = np.array(sorted(shared[i, n]))
                for x, item, bits in self.lookup(group, prints(h, weights, starts, size - k + 1), asked):
                    s = int(starts[x])
                    low, all_ = similarity((h[s:s + size - k + 1], weights[s:s + size - k + 1]), group["own"][item])
                    if SIMILARITY[1] * low >= SIMILARITY[0] * all_:
                        got = (-low / all_, s - first, size, bits)
                        best[item] = min(best.get(item, got), got)
                out += [(a + i, group["ids"][item], s, size, bits, -score) for item, (score, s, size, bits) in best.items()]
        return sorted(out, key=lambda f: (f[0], f[1] is None, f[1] or 0, f[2:]))


def indexes(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", radius: int = RADIUS,
            max_items: int = MAX_ITEMS, max_bytes: int = MAX_BYTES) -> Iterator[Index]:
    """Indexes of bounded size that together hold the whole benchmark."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    n, size = items.agg(F.count("*"), F.sum(F.octet_length("text").cast("long"))).first()
    parts = max(1, -(-n // max_items), -(-(size or 0) // max_bytes))
    if parts > 1:  # dealt out once, not scanned for every part
        path = scratch_path(benchmark.sparkSession, "benchmark")
        (items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int"))
         .write.partitionBy("part").parquet(path))
        items = benchmark.sparkSession.read.schema("item_id long, text string, part int").parquet(path)
    for part in range(parts if n else 0):
        rows = items.where(F.col("part") == part).select("item_id", "text") if parts > 1 else items
        yield Index(sorted(map(tuple, rows.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])), radius)


def _pieces(batch: pa.RecordBatch, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
               radius: int = RADIUS) -> DataFrame:
    """A row for each row of ``docs`` and item it leaks: ``doc_id``, the item and the best window."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([docs.schema["doc_id"], *FOUND.fields])
    spark, out = docs.sparkSession, docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark, radius=radius):
        shared = shipped(spark, index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared()
            for batch in (p for x in batches for p in _pieces(x)):
                found = index.search(batch.column(1).to_pylist())
                ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array([f[i + 1] for f in found], kind) for i, kind in enumerate(
                        (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64()))]],
                    names=["doc_id", *FOUND.names])

        out = out.unionByName(docs.mapInArrow(run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, with their columns, that leak no item."""
    spark = docs.sparkSession
    for index in indexes(benchmark, radius=radius):
        shared = shipped(spark, index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared()
            for batch in (p for x in batches for p in _pieces(x)):
                found = index.search(batch.column(batch.schema.get_field_index(text)).to_pylist())
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[f[0] for f in found]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
