"""Hard-negative mining with STR-packed R-trees: inner products bounded by boxes, searched best first.

Rows are dealt out by ranges of one coordinate (ties by a row number, so equal
vectors are split too) and packed, ``TREE`` at a time, into an R-tree by
sort-tile-recursive packing: slabs by one coordinate, each slab sorted by the
next, ``LEAF`` rows to a leaf, ``FAN`` leaves to a node above.  A tree is one
row of a written table.  For a query ``q`` the box ``[lo, hi]`` of a node
gives an interval for every coordinate's product, and their sum an interval
for the inner product; the bounds of all nodes of a tree for all queries of a
block are two products of matrices.

A task keeps the best rows of each query over all its trees.  In a tree a
queue opens the node of the highest bound first; it skips boxes outside the
score window and stops at the first box strictly below the k-th score, so
ties are still seen.  First come the positives (same label), then, with the
windows that they give, the negatives of all positives of an anchor in one
search.  The anchors are a stated query set against all rows: they go out in
blocks of about ``BLOCK_BYTES``, one pass over the trees for each, and only
the few best rows of a task are shuffled.

The packing order of coordinates is fitted on ``SAMPLE`` rows; it changes how
much is pruned, never the result.

Defined results: rows with a null label or vector, or a null or non-finite
component take no part; vectors of another length are never compared; a row
without an id is no anchor and comes last among equal scores; repeated rows
are separate rows (each anchor row gives its own results, and a copy of an
anchor is one of its positives); fewer positives or negatives than asked give
all there are; an empty vector scores 0; components whose inner products
might not fit 64 bits end the job with an error; other columns are not read,
so their names cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.llm.tables import shipped, stored
from reelrank.session import scratch_path

SCALE = 256
EVERY = 100  # anchors are the rows whose id is divisible by this
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # score window, in percent of the positive's score
LEAF = 128
FAN = 8
TREE = 8192
AXES = 3  # coordinates that a tree is tiled by
SAMPLE = 2000
BLOCK_BYTES = 8 << 20
ROWS_PER_TASK = 1 << 18
_TREE = "tree long, dims int, n int, kind string, cells binary, ids binary, unnamed binary, labels binary, rows binary, starts binary"


# ------------------------------------------------------------------ the trees

def prepared(vectors: DataFrame, label: Column, vec_id: str, embedding: str) -> DataFrame:
    """``row, vec_id, label, x``: the rows that take part, each with a number of its own; written once."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                          F.col(f"`{embedding}`").cast("array<double>").alias("x"))
    rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit integers, small enough for the inner product of two such rows."""
    scaled = np.floor(x * scale)
    top = int(np.abs(scaled).max(initial=0))
    if top * top * max(1, x.shape[-1]) >= 1 << 62:
        raise ValueError("components are too large: inner products would not fit 64 bits")
    return scaled.astype(np.int64)


def axes_of(rows: DataFrame) -> dict[int, list[int]]:
    """For each length of vector, its coordinates by falling spread over a sample; the order in which they are tiled."""
    lists: dict[int, list] = {}
    for r in rows.select("x").limit(SAMPLE).collect():
        lists.setdefault(len(r.x), []).append(r.x)
    return {n: np.argsort(-np.array(v).var(axis=0), kind="stable").tolist() for n, v in lists.items()}


def str_order(x: np.ndarray, axes: list[int], leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Sort-tile-recursive packing: an order of the rows, and where each leaf begins in it."""
    order, starts = [], [0]

    def tile(at: np.ndarray, axes: list[int]) -> None:
        at = at[np.argsort(x[at, axes[0]], kind="stable")] if axes else at
        if len(axes) <= 1 or len(at) <= leaf:
            for i in range(0, len(at), leaf):
                order.append(at[i:i + leaf])
                starts.append(starts[-1] + len(order[-1]))
            return
        leaves = -(-len(at) // leaf)
        slabs = int(np.ceil(leaves ** (1 / len(axes))))
        size = leaf * -(-leaves // slabs)
        for i in range(0, len(at), size):
            tile(at[i:i + size], axes[1:])

    tile(np.arange(len(x)), axes)
    return np.concatenate(order), np.array(starts, dtype=np.int32)


def _build(axes: dict[int, list[int]], scale: int) -> Callable:
    def tree(number: int, part: dict[str, np.ndarray]) -> tuple:
        x = part["x"]
        order, starts = str_order(x, axes.get(x.shape[1], list(range(x.shape[1])))[:AXES])
        top = int(np.abs(x).max(initial=0))
        kind = next((t for t in (np.int8, np.int16, np.int32) if top <= np.iinfo(t).max), np.int64)
        cells = x[order].astype(kind)
        return (number, x.shape[1], len(x), cells.dtype.str, cells.tobytes(), part["vec_id"][order].tobytes(),
                part["unnamed"][order].tobytes(), part["label"][order].tobytes(), part["row"][order].tobytes(), starts.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []  # rows of one length that have no tree yet: fewer than TREE and a batch
        number = 0

        def out(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal held, number
            while held and sum(len(h["row"]) for h in held) >= least:
                every = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
                row = tree(number, {k: v[:TREE] for k, v in every.items()})
                number += 1
                held = [{k: v[TREE:] for k, v in every.items()}] if len(every["row"]) > TREE else []
                yield pa.RecordBatch.from_pydict({f.split()[0]: [v] for f, v in zip(_TREE.split(", "), row)}, schema=pa.schema([
                    ("tree", pa.int64()), ("dims", pa.int32()), ("n", pa.int32()), ("kind", pa.string()),
                    *[(c, pa.binary()) for c in ("cells", "ids", "unnamed", "labels", "rows", "starts")]]))

        for batch in batches:
            c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            sizes = np.diff(np.asarray(c["x"].offsets))
            flat = c["x"].flatten().to_numpy(zero_copy_only=False)
            bounds = np.flatnonzero(np.diff(sizes)) + 1  # sorted by length: runs of one length
            ends = np.cumsum(sizes)
            ids = c["vec_id"].fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            unnamed = c["vec_id"].is_null().to_numpy(zero_copy_only=False)
            for a, b in zip([0, *bounds.tolist()], [*bounds.tolist(), len(sizes)]):
                if a == b:
                    continue
                n = int(sizes[a])
                x = whole(flat[ends[a] - n:ends[b - 1]].reshape(b - a, n), scale)
                if held and held[0]["x"].shape[1] != n:
                    yield from out(1)
                held.append({"x": x, "vec_id": ids[a:b], "unnamed": unnamed[a:b], "row": c["row"].to_numpy()[a:b],
                             "label": c["label"].to_numpy()[a:b]})
                yield from out(TREE)
        yield from out(1)

    return run


def build(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """The table of trees over all ``rows``, written once."""
    spark = rows.sparkSession
    axes, n = axes_of(rows), rows.count()
    first = {d: a[0] for d, a in axes.items() if a}
    axis = F.lit(0)
    for d, a in first.items():
        axis = F.when(F.size("x") == d, F.lit(a)).otherwise(axis)
    parts = max(1, -(-n // ROWS_PER_TASK), min(spark.sparkContext.defaultParallelism, -(-n // (TREE // 4))))
    dealt = rows.select("row", "vec_id", "label", "x", F.size("x").alias("d"), F.get("x", axis).alias("at"))
    dealt = dealt.repartitionByRange(parts, "d", "at", "row").sortWithinPartitions("d", "at", "row")
    return stored(dealt.select("row", "vec_id", "label", "x").mapInArrow(_build(axes, scale), _TREE), "negatives-trees")


@dataclass
class Tree:
    """A tree in a task: rows in packed order, boxes of leaves, then of nodes above, the root last."""

    x: np.ndarray
    ids: np.ndarray
    unnamed: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    lo: np.ndarray = field(init=False)
    hi: np.ndarray = field(init=False)
    below: list = field(init=False)  # children of a node; None for a leaf

    def __post_init__(self) -> None:
        lo = [np.minimum.reduceat(self.x, self.starts[:-1], axis=0)]
        hi = [np.maximum.reduceat(self.x, self.starts[:-1], axis=0)]
        self.below, first = [None] * len(lo[0]), 0
        while len(lo[-1]) > 1:
            at = np.arange(0, len(lo[-1]), FAN)
            self.below += [range(first + a, first + min(a + FAN, len(lo[-1]))) for a in at.tolist()]
            first += len(lo[-1])
            lo.append(np.minimum.reduceat(lo[-1], at, axis=0))
            hi.append(np.maximum.reduceat(hi[-1], at, axis=0))
        self.lo, self.hi = np.concatenate(lo), np.concatenate(hi)

    @classmethod
    def of(cls, r: dict, top: int) -> Tree:
        """The tree of a row of the table, for queries of components up to ``top``.

        Products of floats are exact as long as every sum stays below 2**53, and much faster than whole ones.
        """
        x = np.frombuffer(r["cells"], dtype=r["kind"]).reshape(r["n"], r["dims"])
        small = max(top, int(np.abs(x).max(initial=0))) ** 2 * max(1, r["dims"]) < 1 << 53
        of = lambda c, t: np.frombuffer(r[c], dtype=t)
        return cls(x.astype(np.float64 if small else np.int64), of("ids", "<i8"), of("unnamed", bool), of("labels", "<i8"),
                   of("rows", "<i8"), of("starts", "<i4"))

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that a row in each box can have with each query: exact whole numbers."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return up @ self.lo.T + down @ self.hi.T, up @ self.hi.T + down @ self.lo.T


# ------------------------------------------------------------------ the search

@dataclass
class Best:
    """The first ``k`` rows of a window by score, then id (rows without one last), then row number."""

    k: int
    lo: int
    hi: int
    found: list = field(default_factory=list)  # (-score, unnamed, id, row), sorted

    @property
    def kth(self) -> int:
        """Scores strictly below this cannot get in."""
        return -self.found[-1][0] if len(self.found) == self.k else self.lo

    def add(self, scores: np.ndarray, tree: Tree, at: np.ndarray) -> None:
        ok = np.flatnonzero((scores >= self.kth) & (scores <= self.hi))
        if len(ok) > self.k:  # of many only those from the k-th score of this leaf on
            s = scores[ok]
            ok = ok[s >= np.partition(s, len(s) - self.k)[len(s) - self.k]]
        if len(ok):
            new = zip((-scores[ok]).astype(np.int64).tolist(), tree.unnamed[at[ok]].tolist(), tree.ids[at[ok]].tolist(),
                      tree.rows[at[ok]].tolist())
            self.found = heapq.nsmallest(self.k, [*self.found, *new])


def search(tree: Tree, q: np.ndarray, low: np.ndarray, high: np.ndarray, bests: list[Best], fits: Callable) -> int:
    """Add the rows of ``tree`` to ``bests``; the number of leaves opened.

    ``low`` and ``high`` are the bounds of every node.  Nodes come from a
    queue, the highest bound first (at most the top of the windows).
    """
    top = max(b.hi for b in bests)
    least = min(b.kth for b in bests)
    root, opened = len(tree.lo) - 1, 0
    queue = [(-min(high[root], top), root)] if low[root] <= top else []
    while queue:
        bound, node = heapq.heappop(queue)
        if -bound < least:
            break  # no box left holds a row that gets in
        below = tree.below[node]
        if below is not None:
            for child in below:
                if high[child] >= least and low[child] <= top:
                    heapq.heappush(queue, (-min(high[child], top), child))
            continue
        opened += 1
        at = np.arange(tree.starts[node], tree.starts[node + 1])
        scores = tree.x[at[0]:at[-1] + 1] @ q
        ok = fits(at) & (scores >= least) & (scores <= top)
        if ok.any():
            at, scores = at[ok], scores[ok]
            for b in bests:
                b.add(scores, tree, at)
            least = min(b.kth for b in bests)
    return opened


@dataclass
class Queries:
    """A block of anchors: vectors of any lengths, row numbers, labels and windows ``(lo, hi)`` (None: the positives)."""

    x: list
    rows: list
    labels: list
    windows: list | None
    k: int


_FOUND = "anchor long, window int, score long, vec_id long, row long"
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _searched(trees: DataFrame, queries: Queries) -> DataFrame:
    """The best rows that each task finds for each query and window."""
    get = shipped(trees.sparkSession, queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = get()
        windows = q.windows or [[(_LEAST, _MOST)]] * len(q.rows)
        bests = [[Best(q.k, lo, hi) for lo, hi in w] for w in windows]
        by_dims: dict[int, list[int]] = {}
        for i, x in enumerate(q.x):
            if windows[i]:
                by_dims.setdefault(len(x), []).append(i)
        stacked = {n: np.stack([q.x[k] for k in mine]) for n, mine in by_dims.items()}
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}
                mine = by_dims.get(r["dims"], [])
                if not mine:
                    continue
                every = stacked[r["dims"]]
                tree = Tree.of(r, int(np.abs(every).max(initial=0)))
                for a in range(0, len(mine), 1024):
                    x = every[a:a + 1024].astype(tree.x.dtype)
                    low, high = tree.bounds(x)
                    for j, k in enumerate(mine[a:a + 1024]):
                        label, row = q.labels[k], q.rows[k]
                        if q.windows is None:
                            fits = lambda at: (tree.labels[at] == label) & (tree.rows[at] != row)  # noqa: E731, B023
                        else:
                            fits = lambda at: tree.labels[at] != label  # noqa: E731, B023
                        search(tree, x[j], low[j], high[j], bests[k], fits)
        out = [(q.rows[i], w, -f[0], None if f[1] else f[2], f[3])
               for i, b in enumerate(bests) for w, best in enumerate(b) for f in best.found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in out], pa.int32() if c == 1 else pa.int64()) for c in range(5)],
            names=[f.split()[0] for f in _FOUND.split(", ")])

    return trees.mapInArrow(run, _FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of all tasks, with their ``rank`` from 1."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, label: Column | str = "label", vec_id: str = "vec_id", embedding: str = "embedding",
         every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor and positive.

    Anchors are the rows whose id is divisible by ``every``; a negative's
    score lies between ``low`` and ``high`` percent of its positive's.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors, F.col(f"`{label}`") if isinstance(label, str) else label, vec_id, embedding)
    trees = build(rows, scale)
    anchors = rows.where(F.col("vec_id") % every == 0)
    size = anchors.agg(F.sum(8 * F.size("x") + 64)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    anchors = stored(anchors.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), "negatives-anchors")
    root = scratch_path(spark, "negatives-found")

    def passed(name: str, k: int, windows: bool, of: DataFrame) -> DataFrame:
        for b in range(blocks):  # a block of about BLOCK_BYTES comes to the driver and goes out to the tasks
            held = of.where(F.col("part") == b).collect()
            x = [whole(np.array(r.x, dtype=np.float64), scale) for r in held]
            lists = None
            if windows:
                lists = [[(-(-low * s // 100), high * s // 100) for s in r.scores] for r in held]
            q = Queries(x, [r.row for r in held], [r.label for r in held], lists, k)
            _searched(trees, q).write.parquet(f"{root}/{name}/part={b}")
        return _merged(spark.read.schema(_FOUND).parquet(f"{root}/{name}"), k)

    positive = stored(passed("positives", positives, False, anchors), "negatives-positives")
    # at most ``positives`` rows for each anchor
    lists = positive.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))),
                                                       lambda r: r["score"]).alias("scores"))
    asked = stored(anchors.join(lists.withColumnRenamed("anchor", "row"), "row"), "negatives-asked")
    negative = passed("negatives", negatives, True, asked)
    named = positive.select("anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"),
                            F.col("score").alias("positive_score"))
    return (negative.join(named, ["anchor", "window"])
            .join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
