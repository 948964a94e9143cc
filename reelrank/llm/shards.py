"""Sharding by longest-processing-time scheduling: groups that stay together go to the least-loaded shard.

Rows with equal texts form a group; a group's size is the sum of its rows'
sizes.  Groups are scheduled from the largest down, each to the shard with
the least load, through a heap.  The heap runs on the driver over a bounded
list: a group larger than ``1 / (shards * fine)`` of all bytes is an item of
its own (there are fewer than ``shards * fine`` such groups), and the smaller
groups are first put together, by a hash of the group, into ``shards * fine``
bundles.  So the list has under ``2 * shards * fine`` items at any input size,
and the loads differ by about one bundle at most unless one group alone
exceeds a shard's share.

The text is read once and never shuffled: only ids, sizes and digests move.

Defined results: a null text has no bytes (size 16, checksum 0) and is grouped
with the empty texts; repeated rows are separate rows of one group with slots
of their own; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.llm.tables import stored

SHARDS = 40
FINE = 200
ROW_BYTES = 16
RUN_ROWS = 50_000
_ITEMS = T.StructType([T.StructField("item", T.LongType()), T.StructField("shard", T.IntegerType())])


def schedule(items: list[tuple[int, int]], shards: int) -> list[tuple[int, int]]:
    """``(item, size)`` pairs to ``(item, shard)``: largest first, each to the least-loaded shard, ties by number."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        out.append((item, shard))
    return out


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and a 128-bit key of the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(t) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"), F.unhex(F.md5(t.cast("binary"))).alias("group"))


def assign(docs: DataFrame, shards: int = SHARDS, fine: int = FINE, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, shard, slot``; slots count from 0 in each shard."""
    spark = docs.sparkSession
    rows = stored(measured(docs, doc_id, text), "shard-rows")
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    slots = shards * fine
    large = F.lit(max(1, -(-(total or 0) // slots)))
    bundle = F.pmod(F.xxhash64("group"), F.lit(slots))
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes")).withColumn("big", F.col("bytes") > large)
    # an item is a bundle (0 to slots - 1) or a large group (its hash, below zero)
    big = groups.where("big").select("group", (-1 - F.shiftrightunsigned(F.xxhash64("group"), 1)).alias("big_item"), "bytes")
    big = stored(big, "shard-big")
    small = groups.where(~F.col("big")).groupBy(bundle.alias("item")).agg(F.sum("bytes").alias("bytes"))
    items = small.unionByName(big.groupBy(F.col("big_item").alias("item")).agg(F.sum("bytes").alias("bytes")))
    plan = schedule([tuple(r) for r in items.collect()], shards)  # under 2 * shards * fine rows
    placed = spark.createDataFrame(plan, _ITEMS)
    # both tables have under 2 * shards * fine rows, whatever the input
    sharded = (rows.join(F.broadcast(big.select("group", "big_item")), "group", "left")
               .withColumn("item", F.coalesce("big_item", bundle)).join(F.broadcast(placed), "item"))
    return numbered(sharded, n).select("doc_id", "size", "text_crc32", "shard", "slot")


def numbered(sharded: DataFrame, n: int) -> DataFrame:
    """``slot``: a gapless number from 0 within ``shard``.

    Rows of a shard are cut into runs by a hash, numbered within the run, and moved by the sizes of the runs before
    it, so no task holds a whole shard.  Of equal rows any may come first; they are alike.
    """
    runs = max(1, -(-n // RUN_ROWS))
    run = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(runs))
    cut = sharded.withColumn("run", run)
    sizes = cut.groupBy("shard", "run").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(
        Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))).select(
        "shard", "run", F.coalesce("before", F.lit(0)).alias("before"))
    order = Window.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "size")
    return (cut.withColumn("rank", F.row_number().over(order)).join(before, ["shard", "run"])
            .withColumn("slot", (F.col("before") + F.col("rank") - 1).cast("long")))
