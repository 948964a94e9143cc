"""Statistics job operators: popularity, recency, averages, per-genre top-k,
tag aggregation and the joins that feed them.

Every aggregate here is decomposable (count / sum / min), so Spark combines it
map-side before the shuffle: a movie holding a third of all ratings costs one
partial row per task, not one task holding all its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank import schemas
from reelrank.functions.columns import genre_match, sorted_recs, year_month


def rating_triples(ratings: DataFrame) -> DataFrame:
    """(uid, mid, score): the timestamp is dropped."""
    return ratings.select("uid", "mid", "score")


def rate_more_movies(ratings: DataFrame) -> DataFrame:
    """Number of ratings per movie."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def rate_more_recently(ratings: DataFrame, ordered: bool = False) -> DataFrame:
    """Number of ratings per (month, movie), month as ``yyyyMM`` in UTC.

    All months are kept: "recent" is only the output order (month desc,
    count desc, mid asc), applied when ``ordered``; a stored table has none.
    """
    out = (ratings.select("mid", year_month("timestamp").alias("yearmonth"))
           .groupBy("yearmonth", "mid").agg(F.count("mid").alias("count"))
           .select("mid", "count", "yearmonth"))
    if ordered:
        out = out.orderBy(F.desc("yearmonth"), F.desc("count"), F.asc("mid"))
    return out


def average_movies(ratings: DataFrame) -> DataFrame:
    """Mean score per movie."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def movies_with_avg(movies: DataFrame, averages: DataFrame) -> DataFrame:
    """Movies joined (inner) with their mean score; unrated movies drop out."""
    return movies.join(averages, "mid")


def genre_movies(movies_avg: DataFrame, genres: list[str] | None = None,
                 match: str = "substring") -> DataFrame:
    """(genre, mid, avg) for every genre of ``genres`` a movie matches.

    The genre list is a small literal; matching is a per-row filter of that
    array followed by ``explode``, so there is no join and no broadcast.
    """
    genres = schemas.DEFAULT_GENRES if genres is None else genres
    # explode_outer + NULL filter: a plain explode lets Spark infer and push
    # down size(...) > 0, evaluating the match a second time per movie
    return (movies_avg
            .select("mid", "avg", F.explode_outer(genre_match(F.col("genres"), genres, match)).alias("genre"))
            .filter(F.col("genre").isNotNull())
            .select("genre", "mid", "avg"))


def genres_top_movies(movies_avg: DataFrame, genres: list[str] | None = None, k: int = 10,
                      match: str = "substring") -> DataFrame:
    """Top-``k`` movies by mean score per genre: (genres, recs array<struct<mid, score>>).

    Ranked by ``avg desc, mid asc``.  ``row_number() <= k`` is planned as a
    window group limit, so each task keeps at most ``k`` rows per genre before
    the shuffle; the collected list is therefore bounded by ``k``.
    Genres without a matching movie are absent.
    """
    matched = genre_movies(movies_avg, genres, match)
    w = Window.partitionBy("genre").orderBy(F.desc("avg"), F.asc("mid"))
    top = matched.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return (top.groupBy("genre")
            .agg(sorted_recs(F.collect_list(F.struct("mid", F.col("avg").alias("score")))).alias("recs"))
            .withColumnRenamed("genre", "genres"))


def flatten_recs(lists: DataFrame, key: str, id_field: str = "mid") -> DataFrame:
    """(key, rank, id, score) from a list table; rank is 1-based list position.

    An empty list keeps its key: one row with NULL rank, id and score.
    """
    return (lists.select(key, F.posexplode_outer("recs").alias("pos", "rec"))
            .select(key, (F.col("pos") + 1).alias("rank"),
                    F.col(f"rec.{id_field}").alias(id_field), F.col("rec.score").alias("score")))


def movie_tags(tags: DataFrame) -> DataFrame:
    """(mid, tags): distinct tags of a movie, sorted, joined by ``|``.

    Pairs are de-duplicated first (map-side, then spread over (mid, tag)), so
    a movie that a third of all users tag sends one row per distinct tag.
    """
    return (tags.select("mid", "tag").distinct().groupBy("mid")
            .agg(F.concat_ws("|", F.sort_array(F.collect_list("tag"))).alias("tags")))


def movies_with_tags(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Movies left-joined with their tag string (NULL when untagged)."""
    return movies.join(movie_tags(tags), ["mid"], "left")


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("uid").distinct()


def distinct_movies(ratings: DataFrame) -> DataFrame:
    return ratings.select("mid").distinct()


def user_ratings(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """All ratings of the users listed in ``users`` (a ``uid`` column): a set-wise
    point lookup, planned as a semi join."""
    return ratings.join(users.select("uid"), "uid", "left_semi")
