"""Substring deduplication: words of repeated windows are removed, after a count-min prefilter.

A window is ``window`` consecutive words of one document.  A word goes if a
window over it also starts earlier: in a document of a smaller id, or earlier
in its own.

Plan.  Documents are cut into blocks of about ``block_bytes`` of text, in the
order of their ids, texts and a number that tells equal rows apart, and written
once to a table bucketed by block, so later passes read their blocks without
moving text again.  Cuts are quantiles of the ids weighted by bytes; where an id
(or no id) fills blocks by itself, its rows are cut by the first characters of
their texts, by more of them where these fill blocks, and equal rows anywhere.
A block is larger by what samples miss, or where one text is.

1. Sketch: each block sends, for each row of the sketch, the sorted cells that
   its windows touch, cut by ranges of cells ("slices") and packed as gaps
   (one or two bytes a window).  A slice's lists are merged in one task, which
   counts the blocks that touch each cell - an overestimate of the blocks that
   hold a window, like any count-min - and answers each list with a bit a cell.
   A block touches a cell once however often a window repeats in it, so no
   slice is hot.  The sketch's width follows the input; no task holds it whole.
2. Exact: each block sends the 128-bit hashes of its windows whose least
   estimate is two blocks or more, once each, cut by ranges of hashes.  A
   range's lists are grouped and answered with a bit a hash: is this the first
   block with it?  Windows that repeat in one block only are found there.
3. Removal: each block marks the windows that are not first, and its texts
   lose the words below them.

No window is lost: estimates are never too low.  Windows count as equal if two
independent 64-bit hashes agree.  The driver gets the number of bytes, the
bounds of the blocks, and first characters of sampled texts of ids that fill
blocks, nothing else.

Defined results: a null or empty text has no words; rows with one id are put
in the order of their texts, repeated rows one after another, so the second of
two equal rows is all repeats if it has a window; rows without an id come
first; texts shorter than a window stay; an empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm import words as W
from reelrank.llm.tables import stored
from reelrank.session import scratch_path

WINDOW = 20
BLOCK_BYTES = 8 << 20
DEPTH = 2  # rows of the sketch
SLICE_BITS = 23  # cells of one slice of the sketch
RANGE_WINDOWS = 1 << 22  # windows for each range of hashes
MAX_BUCKETS = 50_000
SAMPLES = 64  # of ids for a block
TEXT_SAMPLES = 8  # of texts for a block of one id
HEAD_CHARS = 256  # of a sampled text; 16 times as many where these fill blocks


def _packed(cells: np.ndarray) -> bytes:
    """Sorted distinct cells as gaps, bytes of one weight together, compressed."""
    gaps = np.diff(cells, prepend=0)
    wide = np.uint8 if not len(gaps) or gaps.max() < 1 << 8 else np.uint16 if gaps.max() < 1 << 16 else np.uint32
    planes = gaps.astype(wide).view(np.uint8).reshape(-1, np.dtype(wide).itemsize).T
    return bytes([np.dtype(wide).itemsize]) + pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _cells(packed: bytes, n: int) -> np.ndarray:
    size = packed[0]
    raw = np.frombuffer(pa.decompress(packed[1:], n * size, codec="zstd", asbytes=True), dtype=np.uint8)
    gaps = np.ascontiguousarray(raw.reshape(size, n).T).view({1: np.uint8, 2: np.uint16, 4: np.uint32}[size])
    return np.cumsum(gaps.reshape(-1), dtype=np.int64)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n).astype(bool)


class _Block:
    """The documents of a block in order, their windows and the windows' hashes."""

    def __init__(self, table: pa.Table, window: int):
        ids = table.column("doc_id").to_pylist()
        texts = W.encoded(table.column("text").combine_chunks())
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i]))
        self.ids, self.texts = [ids[i] for i in order], [texts[i] for i in order]
        self.window, self.bounds = window, [0]
        starts, hashes = [], [[], []]
        for a, b in W.chunks(self.texts):
            w = W.Words(self.texts[a:b])
            at = w.windows(window)
            starts.append(at + self.bounds[-1])
            for k, seed in enumerate(W.HASHES):
                hashes[k].append(W.rolled(w.hashes(seed), window, seed)[at])
            self.bounds += list(self.bounds[-1] + w.bounds[1:])
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, dtype=kind)
        self.starts = join(starts, np.int64)
        self.hash = [join(h, np.uint64) for h in hashes]
        # windows sorted by hash, equal ones in order of their place
        self.order = np.argsort(self.hash[0], kind="stable")
        if self._torn():
            self.order = np.lexsort((self.hash[1], self.hash[0]))
        a, b = (h[self.order] for h in self.hash)
        self.new = np.ones(len(a), dtype=bool)  # in sorted order: first window with its hash
        self.new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])

    def _torn(self) -> bool:
        a, b = (h[self.order] for h in self.hash)
        return bool(np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])))

    def distinct(self) -> list[np.ndarray]:
        """The hashes of the distinct windows, sorted by the first."""
        return [h[self.order[self.new]] for h in self.hash]

    def cells(self, row: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct cells that the distinct windows touch in a sketch row, and each window's place there."""
        a, b = self.distinct()
        h = (a, b)[row] if row < 2 else W.mix(a + np.uint64(row) * b)
        return np.unique((h >> np.uint64(64 - bits)).astype(np.int64), return_inverse=True)


def _parts(values: np.ndarray, shift: int):
    """Ranges of sorted ``values`` with the same value above ``shift`` bits."""
    top = values >> shift
    cut = np.concatenate(([0], np.flatnonzero(top[1:] != top[:-1]) + 1, [len(top)])) if len(top) else [0]
    return [(int(top[a]), int(a), int(b)) for a, b in zip(cut, cut[1:])]


class _Plan:
    """Sizes that follow the input."""

    def __init__(self, text_bytes: int, window: int, depth: int, slice_bits: int, range_windows: int):
        n = max(1, text_bytes // 5)  # windows there can be, for usual word lengths
        self.window, self.depth = window, depth
        self.bits = max(10, math.ceil(math.log2(2 * n)))
        self.slice_bits = min(slice_bits, self.bits)
        self.range_bits = max(1, math.ceil(math.log2(max(1, n / range_windows))))


_LISTS = "slice long, blk int, n int, cells binary"
_ANSWERS = "blk int, kind int, slice long, n int, bits binary"


def _table(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.Table:
    return pa.table({name: pa.array([r[i] for r in rows], type=kind) for i, (name, kind) in enumerate(schema)})


_LIST_TYPES = [("slice", pa.int64()), ("blk", pa.int32()), ("n", pa.int32()), ("cells", pa.binary())]
_ANSWER_TYPES = [("blk", pa.int32()), ("kind", pa.int32()), ("slice", pa.int64()), ("n", pa.int32()), ("bits", pa.binary())]


def _sketch(plan: _Plan):
    def run(table: pa.Table) -> pa.Table:
        block, blk, rows = _Block(table, plan.window), table.column("blk")[0].as_py(), []
        for row in range(plan.depth):
            cells, _ = block.cells(row, plan.bits)
            for s, a, b in _parts(cells, plan.slice_bits):
                rows.append((s * plan.depth + row, blk, b - a, _packed(cells[a:b] - (s << plan.slice_bits))))
        return _table(_LIST_TYPES, rows)

    return run


def _merge(plan: _Plan):
    def run(table: pa.Table) -> pa.Table:
        counts = np.zeros(1 << plan.slice_bits, dtype=np.uint8)
        lists = list(zip(*[table.column(c).to_pylist() for c in ("slice", "blk", "n", "cells")]))
        for _, _, n, packed in lists:
            at = _cells(packed, n)
            counts[at] = np.minimum(counts[at] + 1, 2)
        return _table(_ANSWER_TYPES, [(blk, 0, s, n, _bits(counts[_cells(packed, n)] > 1)) for s, blk, n, packed in lists])

    return run


def _repeated(block: _Block, plan: _Plan, answers: list[tuple]) -> np.ndarray:
    """Which distinct windows are estimated to be in two blocks or more."""
    out = np.ones(int(block.new.sum()), dtype=bool)
    for row in range(plan.depth):
        _, place = block.cells(row, plan.bits)
        own = sorted((s, n, bits) for kind, s, n, bits in answers if kind == 0 and s % plan.depth == row)
        flags = np.concatenate([_flags(bits, n) for _, n, bits in own]) if own else np.zeros(0, dtype=bool)
        out &= flags[place]
    return out


def _answers(table: pa.Table) -> list[tuple]:
    return list(zip(*[table.column(c).to_pylist() for c in ("kind", "slice", "n", "bits")]))


def _candidates(plan: _Plan):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table(_LIST_TYPES, [])
        block, blk = _Block(left, plan.window), left.column("blk")[0].as_py()
        found = _repeated(block, plan, _answers(right))
        a, b = (h[found] for h in block.distinct())
        return _table(_LIST_TYPES, [(s, blk, n - m, a[m:n].tobytes() + b[m:n].tobytes())
                                    for s, m, n in _parts(a, 64 - plan.range_bits)])

    return run


def _first(table: pa.Table) -> pa.Table:
    lists = sorted(zip(*[table.column(c).to_pylist() for c in ("blk", "slice", "n", "cells")]))
    keys = [np.frombuffer(x[3], dtype=np.uint64).reshape(2, -1) for x in lists]
    a, b = (np.concatenate([k[i] for k in keys]) for i in (0, 1))
    order = np.lexsort((b, a))  # stable: lists are in the order of their blocks
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    flags = np.zeros(len(a), dtype=bool)
    flags[order[new]] = True
    ends = np.cumsum([x[2] for x in lists])
    return _table(_ANSWER_TYPES, [(blk, 1, s, n, _bits(flags[e - n:e])) for (blk, s, n, _), e in zip(lists, ends)])


def _remove(plan: _Plan):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block, answers = _Block(left, plan.window), _answers(right)
        found = _repeated(block, plan, answers)
        own = sorted((s, n, bits) for kind, s, n, bits in answers if kind == 1)
        first = np.ones(len(found), dtype=bool)
        if own:
            first[found] = np.concatenate([_flags(bits, n) for _, n, bits in own])
        again = ~block.new  # in sorted order: not the first of its hash in the block
        again |= ~first[np.cumsum(block.new) - 1]
        gone = W.covered(block.starts[block.order[again]], plan.window, block.bounds[-1])
        n_removed, kept = [], []
        for i, t in enumerate(block.texts):
            words, out = t.split(), gone[block.bounds[i]:block.bounds[i + 1]]
            n_removed.append(int(out.sum()))
            kept.append(b" ".join(words if not n_removed[-1] else [x for x, y in zip(words, out) if not y]).decode())
        return pa.table({"doc_id": pa.array(block.ids, pa.int64()), "n_words": pa.array(np.diff(block.bounds), pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    return run


def _sampled(docs: DataFrame, block_bytes: int, samples: int) -> tuple[DataFrame, float]:
    """``docs`` with column ``copies``, on average ``samples`` for ``block_bytes`` of text, and the bytes of a copy."""
    unit = max(1.0, block_bytes / samples)
    share = (F.xxhash64("tie", F.lit(samples)).bitwiseAND((1 << 20) - 1) / F.lit(float(1 << 20)))
    copies = F.floor(F.octet_length("text") / F.lit(unit) + share).cast("int")
    return docs.withColumn("copies", copies).where(F.col("copies") > 0), unit


def _text_cuts(docs: DataFrame, ids: list[int], block_bytes: int) -> dict[int, list[tuple[bytes, int]]]:
    """For each of the ids sorted ``(text, tie)``: a row belongs behind all cuts that are less than its own."""
    rows, unit = _sampled(docs.where(F.col("id").isin(ids)), block_bytes, TEXT_SAMPLES)
    least, most = -(1 << 63), (1 << 63) - 1
    cuts: dict[int, list[tuple[bytes, int]]] = {x: [] for x in ids}
    size, within = HEAD_CHARS, None
    while within is None or within:
        some = rows
        if within:  # only rows below the heads that fill blocks
            table = docs.sparkSession.createDataFrame(within, "id long, head string")
            some = rows.withColumn("head", F.substring("text", 1, size // 16)).join(F.broadcast(table), ["id", "head"], "left_semi")
        heads = (some.groupBy("id", F.substring("text", 1, size).alias("head"), (F.char_length("text") > size).alias("longer"))
                 .agg((F.sum("copies") * unit).alias("bytes")).collect())
        within, place, filled = [], None, 0.0
        for x in sorted(heads, key=lambda r: (r["id"], r["head"].encode(), r["longer"])):
            head = x["head"].encode()
            parent = (x["id"], x["head"][:size // 16] if size > HEAD_CHARS else "")
            if place != parent:
                place, filled = parent, 0.0
            if filled and filled + x["bytes"] > block_bytes:
                cuts[x["id"]].append((head, most if x["longer"] else least))
                filled = 0.0
            filled += x["bytes"]
            if x["bytes"] <= block_bytes:
                continue
            if x["longer"]:
                within.append((x["id"], x["head"]))
            else:  # equal rows, of evenly spread ties
                n = math.ceil(x["bytes"] / block_bytes)
                cuts[x["id"]] += [(head, least + (k << 64) // n) for k in range(1, n)]
        size *= 16
    return {x: sorted(c) for x, c in cuts.items()}


def _blocked(docs: DataFrame, text_bytes: int, block_bytes: int) -> DataFrame:
    """``docs`` with column ``blk``, in the order of ids and texts, as a table bucketed by it."""
    spark = docs.sparkSession
    n = max(1, -(-text_bytes // block_bytes))
    at = [k / n for k in range(1, n)]
    keyed = docs.withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    found: list[int] = []
    if at:
        copies = _sampled(keyed, block_bytes, SAMPLES)[0].select(F.explode(F.array_repeat("id", F.col("copies"))).alias("id"))
        found = copies.agg(F.percentile_approx("id", at, max(10_000, 10 * n))).first()[0] or []
    full = sorted({x for x, y in zip(found, found[1:]) if x == y})
    cuts = _text_cuts(keyed, full, block_bytes) if full else {}
    bounds = np.array(sorted([*set(found), *(x for x, c in cuts.items() for _ in c)]), dtype=np.int64)

    @F.pandas_udf("int")
    def block(ids: pd.Series, texts: pd.Series, ties: pd.Series) -> pd.Series:
        out = np.searchsorted(bounds, ids.to_numpy(), side="left")
        for i in np.flatnonzero(texts.notna().to_numpy()) if cuts else ():
            out[i] += bisect_left(cuts[int(ids.iat[i])], (texts.iat[i].encode(), int(ties.iat[i])))
        return pd.Series(out.astype(np.int32))

    text = F.when(F.col("id").isin(full), F.col("text")) if full else F.lit(None).cast("string")
    name, buckets = f"reelrank_blocks_{uuid.uuid4().hex}", min(len(bounds) + 1, MAX_BUCKETS)
    (keyed.withColumn("blk", block("id", text, "tie")).drop("id", "tie").repartition(buckets, "blk")
     .write.format("parquet").option("path", scratch_path(spark, "blocks")).option("compression", "zstd")
     .bucketBy(buckets, "blk").saveAsTable(name))
    return spark.table(name)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES, depth: int = DEPTH, slice_bits: int = SLICE_BITS,
                   range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept`` (the words left, joined by one space)."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    text_bytes = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    plan = _Plan(text_bytes, window, depth, slice_bits, range_windows)
    blocks = _blocked(docs, text_bytes, block_bytes)
    estimates = stored(blocks.groupBy("blk").applyInArrow(_sketch(plan), _LISTS)
                       .groupBy("slice").applyInArrow(_merge(plan), _ANSWERS), "estimates")
    exact = stored(blocks.groupBy("blk").cogroup(estimates.groupBy("blk")).applyInArrow(_candidates(plan), _LISTS)
                   .groupBy("slice").applyInArrow(_first, _ANSWERS), "firsts")
    answers = estimates.unionByName(exact)
    return blocks.groupBy("blk").cogroup(answers.groupBy("blk")).applyInArrow(
        _remove(plan), "doc_id long, n_words long, n_removed long, kept string")

