"""Projection of the driver's parquet tables onto the movie/rating/tag model.

part -> movie, lineitem x orders -> rating and tag, events -> rating events.
The formulas are the ones fixed in FIXTURES.md so that the DuckDB oracle can
state the same projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.functions.columns import epoch_seconds


def movies_from_parts(part: DataFrame) -> DataFrame:
    words = F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))
    return part.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_type", "p_name").alias("descri"),
        F.concat_ws(" ", F.col("p_size").cast("string"), F.lit("minutes")).alias("timelong"),
        F.lit("September 21, 2004").alias("issue"),
        (F.lit(1950) + F.col("p_size")).cast("string").alias("shoot"),
        F.lit("English").alias("language"),
        F.concat_ws("|", "p_type", "p_brand", words).alias("genres"),
        words.alias("actors"),
        F.col("p_brand").alias("directors"),
    )


def _line_orders(lineitem: DataFrame, orders: DataFrame, *line_cols: str) -> DataFrame:
    li = lineitem.select("l_orderkey", *line_cols)
    od = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"])


def ratings_from_lineitems(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    joined = _line_orders(lineitem, orders, "l_partkey", "l_quantity", "l_shipdate")
    return joined.select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("score"),
        epoch_seconds("l_shipdate").cast("int").alias("timestamp"),
    )


def tags_from_lineitems(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    joined = _line_orders(lineitem, orders, "l_partkey")
    return joined.select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        F.col("o_orderpriority").alias("tag"),
        epoch_seconds("o_orderdate").cast("int").alias("timestamp"),
    )


# Fixed value: a prime that spreads event numbers over all movies.
EVENT_STEP = 7919


def rating_events_from_events(events: DataFrame, part: DataFrame) -> DataFrame:
    movies = part.select(F.count(F.lit(1))).scalar()
    return events.select(
        F.col("user_id").cast("int").alias("uid"),
        F.pmod(F.col("event_id") * EVENT_STEP, movies).cast("int").alias("mid"),
        (((F.col("event_id") * 7 + F.col("user_id")) % 10 + 1).cast("double") / 2).alias("score"),
        epoch_seconds("ts").cast("int").alias("timestamp"),
    )


def rating_messages(rating_events: DataFrame) -> DataFrame:
    """Stream text ``UID|MID|SCORE|TIMESTAMP`` (one ``value`` column, like a text source)."""
    return rating_events.select(
        F.concat_ws("|", "uid", "mid", "score", "timestamp").alias("value"))


@dataclass
class Inputs:
    """Lazily projected inputs of one scale-factor directory."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    @property
    def movies(self) -> DataFrame:
        return movies_from_parts(self.table("part"))

    @property
    def ratings(self) -> DataFrame:
        return ratings_from_lineitems(self.table("lineitem"), self.table("orders"))

    @property
    def tags(self) -> DataFrame:
        return tags_from_lineitems(self.table("lineitem"), self.table("orders"))

    @property
    def rating_events(self) -> DataFrame:
        return rating_events_from_events(self.table("events"), self.table("part"))


def load_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(spark, sf_dir)
