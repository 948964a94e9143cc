"""Centroid clustering: Lloyd's rounds with the columns of vectors and centroids dealt out in blocks.

The kept vectors are written once as cells: up to ``ROWS`` vectors by
``width`` columns.  A task of a column block has that slice of the centroids
alone and gives the exact partial squared distances of its cells;
``reduceByKey`` adds the blocks of a run of vectors and takes the nearest
centroid (ties: the smaller number).  The labels go back to every block,
where each cell sums its columns by cluster, and each block makes its own new
slice: floor of sum by count, in whole numbers of any size; a cluster without
vectors keeps its slice.  Cells stay where they were dealt; only partial
distances (a run of vectors by ``k``) and labels are shuffled.

All arithmetic is exact: components become ``floor(scale * x)``, distances
are summed in 64-bit integers, centroid sums in Python integers.  What the
driver holds and sends is the centroids, ``k * dims`` numbers by parameters
(at most ``MAX_CELLS``), each slice to the tasks of its block only.

Defined results: a vector that is null, has another number of components, or
a null or non-finite one, takes no part; with fewer vectors than ``k`` there
are fewer centroids; repeated rows are separate vectors; a row without an id
is clustered like any other, but starts no centroid; vectors with one id that
both could start a centroid are ordered by their components; a component
beyond ``LARGEST`` after scaling, whose squares would not fit 64 bits, ends
the job with an error; other columns are not read, so their names cannot
clash; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.tables import stored

K = 16
ROUNDS = 3
SCALE = 64
DIMS = 64
WIDTH = 16  # columns in a block
ROWS = 4096  # vectors in a cell
LARGEST = 1 << 27
MAX_CELLS = 1 << 24  # centroids times components
TASK_BYTES = 32 << 20


def kept(vectors: DataFrame, dims: int = DIMS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, x``: rows whose vector has exactly ``dims`` finite components."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    x = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("x"))
    return x.where((F.size("x") == dims) & F.forall("x", finite))


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit integers."""
    scaled = np.floor(x * scale)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling: its square would not fit")
    return scaled.astype(np.int64)


def least(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the fewest bytes."""
    top = int(np.abs(x).max()) if x.size else 0
    return x.astype(next((t for t in (np.int8, np.int16, np.int32) if top <= np.iinfo(t).max), np.int64))


def _cells(rows: DataFrame, dims: int, width: int, scale: int, size: int) -> DataFrame:
    """``chunk, block, n, ids, kind, cells``: runs of ``size`` vectors, cut into blocks of columns; ids with block 0."""
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            x = whole(lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale)
            for a in range(0, len(x), size):
                part, out = x[a:a + size], []
                for b, at in enumerate(range(0, dims, width)):
                    cells = least(part[:, at:at + width])
                    named = ids[a:a + size].to_pylist() if b == 0 else None
                    out.append((chunk, b, len(part), named, cells.dtype.str, cells.tobytes()))
                chunk += 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()),
                    pa.array([r[2] for r in out], pa.int32()), pa.array([r[3] for r in out], pa.list_(ids.type)),
                    pa.array([r[4] for r in out]), pa.array([r[5] for r in out], pa.binary()),
                ], names=["chunk", "block", "n", "ids", "kind", "cells"])

    return rows.mapInArrow(run, f"chunk long, block int, n int, ids array<{id_type}>, kind string, cells binary")


def first_centroids(rows: DataFrame, k: int, scale: int, seed: str = "1") -> np.ndarray:
    """The ``k`` vectors whose ``seed:id`` has the smallest SHA-256, in that order: ``k * dims`` numbers."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = rows.where(F.col("vec_id").isNotNull()).select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()
    return whole(np.array([r.x for r in found], dtype=np.float64), scale)


def partial_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to those of ``c``."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    # products by the float unit are exact as long as every sum stays below 2**53
    kind = np.float64 if 4 * x.shape[1] * top * top < 1 << 53 else np.int64
    x, c = x.astype(kind), c.astype(kind)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) + b


def nearest(blocks: RDD, slices: list, parts: int) -> RDD:
    """``chunk, (labels, distances)``: partial distances of every block, added by chunk, and the least of each row."""
    def partial(part):
        for (block, chunk), (kind, cells) in part:
            c = slices[block].value
            x = np.frombuffer(cells, dtype=kind).reshape(-1, c.shape[1])
            yield chunk, least(partial_distances(x, c))

    def chosen(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        label = total.argmin(axis=1)
        return least(label), np.take_along_axis(total, label[:, None], 1)[:, 0].astype(np.int64)

    return blocks.mapPartitions(partial).reduceByKey(_added, parts).mapValues(chosen)


def _sums(x: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(labels, kind="stable")
    found, first = np.unique(labels[order], return_index=True)
    counts, sums = np.zeros(k, dtype=object), np.zeros((k, x.shape[1]), dtype=object)  # whole numbers of any size
    counts[found] = np.diff(np.append(first, len(labels))).astype(object)
    sums[found] = np.add.reduceat(x[order].astype(np.int64), first, axis=0).astype(object)
    return counts, sums


def new_slices(blocks: RDD, labels: RDD, slices: list, k: int, parts: int) -> dict[int, np.ndarray]:
    """Each block's slice of the next centroids, made in that block's own reduce task."""
    n = len(slices)
    told = labels.flatMap(lambda r: [((b, r[0]), r[1][0]) for b in range(n)]).partitionBy(parts)

    def summed(part):
        acc: dict[int, tuple] = {}
        for (block, _), ((kind, cells), label) in part:
            x = np.frombuffer(cells, dtype=kind).reshape(len(label), -1)
            add = _sums(x, label.astype(np.int64), k)
            acc[block] = tuple(map(np.add, acc[block], add)) if block in acc else add
        return iter(acc.items())

    def moved(r):
        block, (counts, sums) = r
        old = slices[block].value
        new = np.where((counts > 0)[:, None], sums // np.maximum(counts, 1)[:, None], old)
        return block, new.astype(np.int64)

    joined = blocks.join(told, parts)  # dealt out alike: the cells stay where they are
    return dict(joined.mapPartitions(summed).reduceByKey(lambda a, b: tuple(map(np.add, a, b)), parts).map(moved).collect())


def lloyd(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS, width: int = WIDTH,
          seed: str = "1", vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every kept vector after ``rounds`` rounds, and the final centroids."""
    if k * dims > MAX_CELLS:
        raise ValueError(f"{k} centroids of {dims} components are more than {MAX_CELLS} numbers")
    spark = vectors.sparkSession
    sc = spark.sparkContext
    rows = kept(vectors, dims, vec_id, embedding)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    size = max(64, min(ROWS, (1 << 20) // k))
    grid = stored(_cells(rows, dims, width, scale, size), "centroid-cells")
    n = grid.where("block = 0").agg(F.sum("n")).first()[0] or 0
    centroids = first_centroids(rows, k, scale, seed) if n else np.zeros((0, dims), dtype=np.int64)
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {id_type}, cluster int, distance long"), centroids
    parts = int(max(sc.defaultParallelism, -(-n * dims * 4 // TASK_BYTES)))
    blocks = (grid.select("chunk", "block", "kind", "cells").rdd
              .map(lambda r: ((r.block, r.chunk), (r.kind, bytes(r.cells)))).partitionBy(parts)
              .persist(StorageLevel.MEMORY_AND_DISK))
    starts = range(0, dims, width)
    try:
        for left in range(rounds, -1, -1):
            slices = [sc.broadcast(centroids[:, at:at + width]) for at in starts]
            found = nearest(blocks, slices, parts)
            if left:
                new = new_slices(blocks, found, slices, len(centroids), parts)
                centroids = np.concatenate([new[b] for b in range(len(starts))], axis=1)
        told = spark.createDataFrame(found.map(lambda r: (
            r[0], r[1][0].astype("<i4").tobytes(), r[1][1].astype("<i8").tobytes())),
            "chunk long, labels binary, distances binary")
        told = stored(told, "centroid-labels")
    finally:
        blocks.unpersist()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[i].values, pa.array(np.frombuffer(batch.column(1)[i].as_py(), "<i4")),
                    pa.array(np.frombuffer(batch.column(2)[i].as_py(), "<i8"))], names=["vec_id", "cluster", "distance"])

    named = grid.where("block = 0").select("chunk", "ids").join(told, "chunk").select("ids", "labels", "distances")
    return named.mapInArrow(spread, f"vec_id {id_type}, cluster int, distance long"), centroids


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS, width: int = WIDTH,
            seed: str = "1", vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """:func:`lloyd` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` (of its decimals, joined by commas)."""
    found, centroids = lloyd(vectors, k, rounds, scale, dims, width, seed, vec_id, embedding)
    sums = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # at most k rows
    rows = [(i, int(sums[i]), int(sum(sums.values())), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
            for i, c in enumerate(centroids) if i in sums]
    per = vectors.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
