"""Real-time recommendations as a Structured Streaming query.

    source (text files or Kafka, in arrival order)
    -> foreachBatch, all set-wise in Spark:
       parse ``UID|MID|SCORE|TIMESTAMP``; messages that do not parse go to the
       Rejected table of the same batch;
       last event per user; recents = the batch's events, then the user's kept
       recents, then (users met for the first time) their stored ratings;
       scoring of the batch's users (operators.realtime)
    -> Rejected, Recents and StreamRecs, tables with a committed version per
       batch (streaming.log; idempotent on replay)

Offsets live in the query's checkpoint, so a restarted query resumes where
the last committed batch ended; a replayed batch reads the version that the
batch before it left and puts its own in place again.  No state store, no
Python worker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank import schemas
from reelrank.operators import realtime
from reelrank.operators.factored import FactoredSims
from reelrank.operators.history import RatingHistory, UserHistory, list_rows, recents_as_lists, touched_buckets
from reelrank.streaming.log import BUCKETS, FAN, BatchTable, UserLog


def parse_rating_messages(messages: DataFrame, strict: bool = True, keep: list[str] | None = None) -> DataFrame:
    """``value`` = ``UID|MID|SCORE|TIMESTAMP`` -> (uid, mid, score, timestamp); ``arrival`` is kept if there is one, and
    the columns ``keep``."""
    parts = F.split(F.col("value"), r"\|", -1)

    def num(i: int, t: str):
        if strict:
            return parts.getItem(i).cast(t)
        return F.get(parts, F.lit(i)).try_cast(t)

    return messages.select(num(0, "int").alias("uid"), num(1, "int").alias("mid"),
                           num(2, "double").alias("score"), num(3, "int").alias("timestamp"),
                           *(keep or []), *[c for c in messages.columns if c == "arrival"])


def split_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed events, and the messages (``value``) that are none: a field is missing, not a number or out of range.
    Further fields are ignored, as in the reference."""
    fields = parse_rating_messages(messages, strict=False, keep=["value"])
    columns = schemas.RATING_COLUMNS
    good = F.lit(True)
    for c in columns:
        good = good & F.col(c).isNotNull()
    rest = [c for c in fields.columns if c == "arrival"]
    return fields.where(good).select(*columns, *rest), fields.where(~good).select("value")


def rating_stream(spark: SparkSession, fmt: str = "text", path: str | None = None,
                  **options: str) -> DataFrame:
    """Streaming DataFrame of message strings (column ``value``) with their order of arrival (column ``arrival``).

    ``fmt="text"`` reads new files of a directory (``maxFilesPerTrigger``
    bounds a batch); files arrive by modification time, then by name, and
    their lines in order (numbered when a batch is read, as a stream cannot).  ``fmt="kafka"`` takes the usual Kafka source options
    (``kafka.bootstrap.servers``, ``subscribe``, ``startingOffsets`` --
    ``latest`` by default, as in the reference; ``maxOffsetsPerTrigger``);
    messages arrive by broker time, then by partition and offset.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"startingOffsets": "latest", **options}
    reader = reader.options(**options)
    df = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        order = F.struct("timestamp", "partition", "offset")
    else:
        meta = F.col("_metadata")
        order = F.struct(meta["file_modification_time"].alias("time"), meta["file_path"].alias("file"),
                         meta["file_block_start"].alias("block"))
    return df.select(F.col("value").cast("string").alias("value"), order.alias("arrival"))


# ---------------------------------------------------------------- StreamRecs

def write_stream_recs(recs: DataFrame, root: str, batch_id: int, fan: int = FAN) -> None:
    """Write one batch's lists (uid, recs) to the table at ``root``; writing a batch again replaces only its own rows."""
    UserLog(recs.sparkSession, root, fan=fan).write(recs, batch_id)


def current_stream_recs(spark: SparkSession, root: str) -> DataFrame:
    """(uid, recs): the latest list per user (last write wins), as the committed version has it."""
    found = UserLog(spark, root).latest()
    return spark.createDataFrame([], f"uid int, recs array<{schemas.RECOMMENDATION}>") if found is None else found


def rejected_messages(spark: SparkSession, root: str) -> DataFrame:
    """(value, batch_id): the messages of the query with sink ``root`` that did not parse."""
    found = BatchTable(spark, f"{root.rstrip('/')}_rejected").rows()
    return spark.createDataFrame([], "value string, batch_id long") if found is None else found


# ---------------------------------------------------------------- micro-batch

def merged_recents(events: DataFrame, kept: DataFrame | None, history: DataFrame, k: int) -> DataFrame:
    """(uid, pos, mid, score, timestamp): newest ``k`` per user: the batch's events in reverse order of arrival, then
    the recents kept from earlier batches, or else the stored ratings.  At most ``3 k`` rows of a user meet."""
    parts = [realtime.recent_ratings(events, k).withColumn("age", F.lit(0))]
    stored = history
    if kept is not None:
        stored = stored.join(kept.select("uid"), "uid", "left_anti")
        parts.append(list_rows(kept).withColumn("age", F.lit(1)))
    parts.append(stored.select("uid", "pos", "mid", "score", "timestamp").withColumn("age", F.lit(2)))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    place = F.row_number().over(Window.partitionBy("uid").orderBy("age", "pos"))
    return (every.withColumn("place", place).where(F.col("place") <= k)
            .select("uid", (F.col("place") - 1).alias("pos"), "mid", "score", "timestamp"))


def realtime_batch_handler(spark: SparkSession, history: DataFrame | UserHistory, sims: DataFrame | FactoredSims,
                           sink_root: str, k: int = schemas.MAX_USER_RATINGS_NUM, n: int = schemas.MAX_SIM_MOVIES_NUM,
                           threshold: float = schemas.STREAM_SIM_THRESHOLD, adjust: str = "as_written",
                           buckets: int = BUCKETS, fan: int = FAN):
    """The ``foreachBatch`` function: score the users of one micro-batch of messages (``value``) or parsed events.

    ``history`` is what is stored of the users' ratings: the tables of
    :class:`UserHistory`, of which a batch reads the directories of its users'
    buckets, or the rating table itself, which every batch scans.
    """
    held_ratings = RatingHistory(history, k) if isinstance(history, DataFrame) else history
    recs_log = UserLog(spark, sink_root, buckets=buckets, fan=fan)
    recents_log = UserLog(spark, f"{sink_root.rstrip('/')}_recents", buckets=buckets, fan=fan, value="recents")
    rejected = BatchTable(spark, f"{sink_root.rstrip('/')}_rejected", fan=fan)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if "arrival" in batch.columns:  # lines of one file block share its place: their order in it decides
            batch = batch.withColumn("arrival", F.struct("arrival", F.monotonically_increasing_id().alias("line")))
        held = [batch.persist()]
        try:
            if "value" in batch.columns:
                batch, bad = split_messages(batch)
                if not bad.isEmpty():
                    rejected.write(bad, batch_id)
            if batch.isEmpty():
                return
            last = realtime.last_events(batch).persist()
            held.append(last)
            users = last.select("uid")
            # the numbers of the users' buckets: bounded, whatever the number of users
            touched = touched_buckets(users, buckets)
            stored = touched if held_ratings.buckets == buckets else None
            seen = held_ratings.seen(users, stored).persist()
            kept = recents_log.latest(batch_id, touched)
            if kept is not None:
                kept = kept.join(users, "uid", "left_semi").persist()
                held.append(kept)
            recents = merged_recents(batch, kept, held_ratings.recents(users, stored), k).persist()
            held += [seen, recents]
            recents_log.write(recents_as_lists(recents), batch_id)
            recs = realtime.score_users(last, recents, sims, seen, n, threshold, adjust, keep=held)
            recs_log.write(recs, batch_id)
        finally:
            for df in held:
                df.unpersist()
    return handle


def start_realtime_query(spark: SparkSession, messages: DataFrame, history: DataFrame | UserHistory,
                         sims: DataFrame | FactoredSims, sink_root: str, checkpoint_location: str,
                         trigger: dict | None = None, k: int = schemas.MAX_USER_RATINGS_NUM,
                         n: int = schemas.MAX_SIM_MOVIES_NUM, threshold: float = schemas.STREAM_SIM_THRESHOLD,
                         adjust: str = "as_written", buckets: int = BUCKETS, fan: int = FAN, strict: bool = False):
    """Start the streaming query; returns the ``StreamingQuery``.

    ``trigger`` defaults to a 20 second processing-time cadence (the
    reference's batch interval); tests pass ``{"availableNow": True}``.  A
    message that does not parse goes to the Rejected table
    (:func:`rejected_messages`) and the query goes on; with ``strict`` it
    ends the query.
    """
    handler = realtime_batch_handler(spark, history, sims, sink_root, k, n, threshold, adjust, buckets, fan)
    writer = ((parse_rating_messages(messages) if strict else messages).writeStream.outputMode("append").foreachBatch(handler)
              .option("checkpointLocation", checkpoint_location)
              .trigger(**(trigger or {"processingTime": "20 seconds"})))
    return writer.start()


# ---------------------------------------------------------------- offsets

def starting_offsets(offsets: DataFrame) -> DataFrame:
    """(group, starting_offsets): stored ``(group, topic_partition, offset)``
    rows -> the JSON the Kafka source takes as ``startingOffsets``
    (``{"topic": {"0": 42, ...}}``), partitions in numeric order.

    ``topic_partition`` is split at its *last* ``-``, so topics may contain
    dashes.
    """
    pattern = r"^(.*)-([0-9]+)$"
    rows = offsets.select(
        "group",
        F.regexp_extract("topic_partition", pattern, 1).alias("topic"),
        F.regexp_extract("topic_partition", pattern, 2).cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"))
    per_topic = (rows.groupBy("group", "topic")
                 .agg(F.sort_array(F.collect_list(F.struct("partition", "offset"))).alias("p"))
                 .select("group", "topic", F.map_from_entries(F.transform(
                     "p", lambda x: F.struct(x["partition"].cast("string"), x["offset"]))).alias("m")))
    return (per_topic.groupBy("group")
            .agg(F.array_sort(F.collect_list(F.struct("topic", "m")), lambda a, b: (
                F.when(a["topic"] < b["topic"], -1).when(a["topic"] > b["topic"], 1).otherwise(0))).alias("t"))
            .select("group", F.to_json(F.map_from_entries("t")).alias("starting_offsets")))
