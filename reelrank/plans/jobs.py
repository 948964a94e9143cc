"""The recommender's jobs, wired from operators and sinks.

Each job reads its inputs lazily, writes its result tables below ``out_root``
(one directory per table, replaced as a whole) and returns the paths.  Only
single numbers, the tuner's grid and the ids of a micro-batch of bounded size
reach the driver, never table data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelrank import schemas
from reelrank.operators import content, latent, stats
from reelrank.operators.factored import FactoredSims
from reelrank.operators.history import BUCKETS, UserHistory
from reelrank.session import scratch_path
from reelrank.sources import tables, text

# Result table names.
RATE_MORE_MOVIES = "RateMoreMovies"
RATE_MORE_RECENTLY_MOVIES = "RateMoreRecentlyMovies"
AVERAGE_MOVIES = "AverageMovies"
GENRES_TOP_MOVIES = "GenresTopMovies"
USER_TO_MOVIE = "UserToMovie"
MOVIE_TO_USER = "MovieToUser"
CONTENT_MOVIE_RECS = "ContentMovieRecs"
CONTENT_SIMILARITY = "ContentSimilarity"
STREAM_RECS = "StreamRecs"


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def load_job(spark: SparkSession, movie_text: str, rating_text: str, tag_text: str, out_root: str,
             search_path: str | None = None, fmt: str = "parquet", search_fmt: str = "json",
             strict: bool = True) -> dict[str, str]:
    """Parse the three delimited files, store the base tables and the search
    documents (movie + its tags, keyed by mid).

    A bad line fails a strict load.  Otherwise the bad lines of each file go
    to ``rejected_<table>`` as text, and the good ones to the table.
    """
    good, paths = {}, {}
    for kind, path in (("movie", movie_text), ("rating", rating_text), ("tag", tag_text)):
        if strict:
            good[kind] = text.read_text_table(spark, path, kind)
        else:
            parsed = text.parse_lines(spark.read.text(path), kind, strict=False, keep_line=True)
            valid, invalid = text.split_invalid(parsed, kind)
            good[kind] = valid.drop("line")
            paths[f"rejected_{kind}"] = _path(out_root, f"rejected_{kind}")
            tables.write_table(invalid.select("line"), paths[f"rejected_{kind}"], "text")
    paths |= tables.store_base_tables(good["movie"], good["rating"], good["tag"], out_root, fmt)
    if search_path:
        stored_movies = tables.read_movies(spark, paths["movie"], fmt)
        stored_tags = tables.read_tags(spark, paths["tag"], fmt)
        tables.write_search_documents(stats.movies_with_tags(stored_movies, stored_tags), search_path, search_fmt)
        paths["search"] = search_path
    return paths


def statistics_job(movies: DataFrame, ratings: DataFrame, out_root: str, genres: list[str] | None = None,
                   k: int = schemas.GENRE_TOP_K, fmt: str = "parquet") -> dict[str, str]:
    """Popularity, monthly popularity, mean score and per-genre top-k tables.

    The mean per movie is computed once and reused by the genre ranking (it
    is one row per movie, so caching it is cheap at any scale).
    """
    out = {n: _path(out_root, n) for n in (RATE_MORE_MOVIES, RATE_MORE_RECENTLY_MOVIES, AVERAGE_MOVIES,
                                          GENRES_TOP_MOVIES)}
    tables.write_table(stats.rate_more_movies(ratings), out[RATE_MORE_MOVIES], fmt)
    tables.write_table(stats.rate_more_recently(ratings), out[RATE_MORE_RECENTLY_MOVIES], fmt)
    averages = stats.average_movies(ratings).persist()
    try:
        tables.write_table(averages, out[AVERAGE_MOVIES], fmt)
        top = stats.genres_top_movies(stats.movies_with_avg(movies, averages), genres, k)
        tables.write_table(top, out[GENRES_TOP_MOVIES], fmt)
    finally:
        averages.unpersist()
    return out


def offline_job(ratings: DataFrame, out_root: str, params: latent.AlsParams = latent.AlsParams(),
                k: int = schemas.ALS_TOP_K, fmt: str = "parquet", exclude_rated: bool = False) -> dict[str, str]:
    """ALS fit, then top-k movies per user and top-k users per movie.
    ``exclude_rated`` leaves a user's rated movies out of their list."""
    model = latent.fit_als(stats.rating_triples(ratings), params)
    out = {USER_TO_MOVIE: _path(out_root, USER_TO_MOVIE), MOVIE_TO_USER: _path(out_root, MOVIE_TO_USER)}
    tables.write_table(latent.user_recs(model, k, exclude=ratings if exclude_rated else None),
                       out[USER_TO_MOVIE], fmt)
    tables.write_table(latent.item_recs(model, k), out[MOVIE_TO_USER], fmt)
    return out


def tuning_job(ratings: DataFrame, ranks=(50, 100), alphas=(0.01, 0.02), reg_params=latent.TUNER_REG,
               seed: int | None = None) -> DataFrame:
    """The ALS grid on an 80/20 split, written once and read by every fit; returns the best
    (rank, alpha, reg_param, rmse) row."""
    spark, path = ratings.sparkSession, scratch_path(ratings.sparkSession, "als_split")
    latent.rating_split(ratings, seed=seed).write.partitionBy("split").parquet(path)
    split = spark.read.parquet(path)
    train = split.filter(split["split"] == "train")
    test = split.filter(split["split"] == "test")
    return latent.best_params(latent.als_grid(train, test, ranks, alphas, reg_params))


def content_job(movies: DataFrame, out_root: str, threshold: float = schemas.CONTENT_SIM_THRESHOLD,
                num_features: int = schemas.HASHING_FEATURES, term_space: str = "hash",
                k: int | None = None, fmt: str = "parquet", write_pairs: bool = False,
                write_lists: bool = False) -> dict[str, str]:
    """The similarity tables, factored by class (members, vectors, class lists): all that the real-time job reads.

    On demand they are expanded: with ``write_lists`` to one list per movie
    (ContentMovieRecs; ``k`` cuts the lists), with ``write_pairs`` to the long
    pair table (ContentSimilarity: mid, other_mid, score).
    """
    model = content.content_model(movies, threshold, num_features, term_space)
    if write_pairs or write_lists:
        model.keep_class_pairs()
    out = FactoredSims.of(model).write(out_root, fmt)
    if write_pairs:
        out[CONTENT_SIMILARITY] = _path(out_root, CONTENT_SIMILARITY)
        tables.write_table(model.pairs(), out[CONTENT_SIMILARITY], fmt, sort_by=["mid"])
    if write_lists:
        out[CONTENT_MOVIE_RECS] = _path(out_root, CONTENT_MOVIE_RECS)
        tables.write_table(model.recs(k), out[CONTENT_MOVIE_RECS], fmt)
    model.unpersist()
    return out


def history_job(ratings: DataFrame, out_root: str, buckets: int = BUCKETS,
                k: int = schemas.MAX_USER_RATINGS_NUM) -> dict[str, str]:
    """What the real-time job reads of the stored ratings: seen sets and newest ratings per user, in ``buckets``
    directories (replaced as a whole); run it when the rating table has changed."""
    return UserHistory.write(ratings, out_root, buckets, k)


def realtime_job(spark: SparkSession, messages: DataFrame, history: DataFrame | UserHistory, content_root: str,
                 out_root: str, checkpoint_location: str, trigger: dict | None = None, fmt: str = "parquet",
                 threshold: float = schemas.CONTENT_SIM_THRESHOLD, buckets: int = BUCKETS, strict: bool = False):
    """Start the streaming recommender against the tables that ``content_job`` stored below ``content_root``
    (``threshold``: its similarity threshold); returns the running query (StreamRecs below ``out_root``).

    A micro-batch opens the first bands of the class lists, the members and
    vectors of the movies it meets, and of the ``history`` that
    ``history_job`` stored the directories of its users' buckets: no
    movie-pair table, no rating table.  (A rating table given as ``history``
    is scanned by every batch.)  Messages that do not parse go to a table of
    their own, unless ``strict``.
    """
    from reelrank.streaming import start_realtime_query

    sims = FactoredSims.read(spark, content_root, threshold, fmt)
    return start_realtime_query(spark, messages, history, sims, _path(out_root, STREAM_RECS),
                                checkpoint_location, trigger, buckets=buckets, strict=strict)
