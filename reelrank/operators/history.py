"""What the real-time job needs of the stored ratings: the movies that a user has seen, and their newest ratings.

Two tables, both in directories by the bucket of the user and sorted by user:

* ``Seen`` (uid, part, ids): the user's distinct movies, sorted, at most
  ``PART`` in a row.  Sorted ids are written delta-packed (the file format's
  encoding for whole numbers), about a byte or two each, and a user with a
  third of all ratings is many rows;
* ``Recents`` (uid, recents): the user's newest ratings, at most ``k``.

A micro-batch reads the directories of its users' buckets, whatever the number
of its users: the bucket numbers (at most ``buckets`` values) are a filter on
the partition directories, and the users join their bucket's rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank import schemas
from reelrank.operators import realtime
from reelrank.operators.ranks import numbered
from reelrank.sources.tables import user_bucket

PART = 4096
BUCKETS = 64

# Names of the stored tables.
SEEN, RECENTS = "Seen", "Recents"

RECENT_LIST = "array<struct<pos:int,mid:int,score:double,timestamp:int>>"

#: Parquet settings under which sorted whole numbers are delta-packed.
PACKED = {"parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}


def seen_sets(ratings: DataFrame, part: int = PART) -> DataFrame:
    """(uid, part, ids): each user's distinct movies in order, at most ``part`` of them in a row."""
    rows = numbered(ratings.select("uid", "mid").distinct(), ["uid"], "mid")
    return (rows.groupBy("uid", F.floor(F.col("pos") / part).cast("int").alias("part"))
            .agg(F.sort_array(F.collect_list("mid")).alias("ids")))


def recent_lists(ratings: DataFrame, k: int = schemas.MAX_USER_RATINGS_NUM) -> DataFrame:
    """(uid, recents): each user's ``k`` newest ratings, newest first."""
    return recents_as_lists(realtime.recent_ratings(ratings, k))


def recents_as_lists(recents: DataFrame) -> DataFrame:
    """Rows (uid, pos, mid, score, timestamp) as one list per user; the rows of a user are bounded."""
    return recents.groupBy("uid").agg(F.sort_array(F.collect_list(
        F.struct("pos", "mid", "score", "timestamp"))).cast(RECENT_LIST).alias("recents"))


def list_rows(lists: DataFrame) -> DataFrame:
    """(uid, pos, mid, score, timestamp) of recents lists."""
    return lists.select("uid", F.explode("recents").alias("r")).select("uid", "r.*")


def touched_buckets(users: DataFrame, buckets: int) -> list[int]:
    """The buckets of ``users (uid)``: at most ``buckets`` numbers."""
    found = users.select(F.coalesce(user_bucket("uid", buckets), F.lit(0)).alias("b")).distinct().collect()
    return sorted(r.b for r in found)


@dataclass
class RatingHistory:
    """The same, straight from a table of ratings (uid, mid, score, timestamp): every batch scans it."""

    ratings: DataFrame
    k: int = schemas.MAX_USER_RATINGS_NUM
    buckets: int = 0

    def _of(self, users: DataFrame) -> DataFrame:
        return self.ratings.select("uid", "mid", "score", "timestamp").join(users.select("uid"), "uid", "left_semi")

    def seen(self, users: DataFrame, touched: list[int] | None = None) -> DataFrame:
        """(uid, mid): the movies that the users have rated."""
        return self._of(users).select("uid", "mid").distinct()

    def recents(self, users: DataFrame, touched: list[int] | None = None) -> DataFrame:
        """(uid, pos, mid, score, timestamp): the newest ratings of the users."""
        return realtime.recent_ratings(self._of(users), self.k)


@dataclass
class UserHistory:
    """The stored tables."""

    seen_table: DataFrame
    recents_table: DataFrame
    buckets: int

    @staticmethod
    def write(ratings: DataFrame, root: str, buckets: int = BUCKETS, k: int = schemas.MAX_USER_RATINGS_NUM) -> dict[str, str]:
        """Replace the two tables below ``root``; returns their paths."""
        paths = {name: f"{root.rstrip('/')}/{name}" for name in (SEEN, RECENTS)}
        for name, rows, order in ((SEEN, seen_sets(ratings), ["uid", "part"]), (RECENTS, recent_lists(ratings, k), ["uid"])):
            (rows.withColumn("uid_bucket", F.coalesce(user_bucket("uid", buckets), F.lit(0)))
             .hint("rebalance", "uid_bucket").sortWithinPartitions("uid_bucket", *order)
             .write.mode("overwrite").options(**PACKED).partitionBy("uid_bucket").parquet(paths[name]))
        return paths

    @classmethod
    def read(cls, spark: SparkSession, root: str, buckets: int = BUCKETS) -> UserHistory:
        """The tables below ``root``, written with so many ``buckets``."""
        table = lambda name, schema: spark.read.schema(f"uid int, {schema}, uid_bucket int").parquet(f"{root.rstrip('/')}/{name}")
        return cls(table(SEEN, "part int, ids array<int>"), table(RECENTS, f"recents {RECENT_LIST}"), buckets)

    def _of(self, table: DataFrame, users: DataFrame, touched: list[int] | None) -> DataFrame:
        touched = touched_buckets(users, self.buckets) if touched is None else touched
        keyed = users.select("uid", F.coalesce(user_bucket("uid", self.buckets), F.lit(0)).alias("uid_bucket"))
        return table.where(F.col("uid_bucket").isin(touched)).join(keyed, ["uid_bucket", "uid"], "left_semi")

    def seen(self, users: DataFrame, touched: list[int] | None = None) -> DataFrame:
        """(uid, mid): the movies that the users have rated."""
        return self._of(self.seen_table, users, touched).select("uid", F.explode("ids").alias("mid"))

    def recents(self, users: DataFrame, touched: list[int] | None = None) -> DataFrame:
        """(uid, pos, mid, score, timestamp): the newest ratings of the users."""
        return list_rows(self._of(self.recents_table, users, touched))
