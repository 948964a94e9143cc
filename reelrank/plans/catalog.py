"""
``(spark, sf_dir) -> DataFrame`` over the whole driver tables, plus the
DuckDB statement that must give the same rows (``None`` = rows-only check).

Nested lists are flattened to (key, rank, id, score) so both engines can be
compared row by row; doubles that depend on summation order are rounded to
6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank import schemas, streaming
from reelrank.operators import content, latent, realtime, stats
from reelrank.operators.factored import FactoredSims
from reelrank.operators.history import UserHistory
from reelrank.plans.oracle import CONTENT_CTES, EXACT_CTES, REALTIME_CTES, with_ctes
from reelrank.session import scratch_path, written
from reelrank.sources import fixtures, tables, text
from reelrank.sources.fixtures import load_inputs

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# The genre list that exercises the fixture genre strings
# (FIXTURES.md section 3); the reference's own 20 genres match none of them.
FIXTURE_GENRES = ["Economy", "Old", "Ring", "Red", "Western"]


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- sources

@register("movies_typed", with_ctes(["movie"], [], "SELECT * FROM movie"))
def q_movies_typed(spark, sf):
    return tables.typed(load_inputs(spark, sf).movies, schemas.MOVIE)


@register("ratings_typed", with_ctes(["rating"], [], "SELECT * FROM rating"))
def q_ratings_typed(spark, sf):
    return tables.typed(load_inputs(spark, sf).ratings, schemas.RATING)


@register("rating_triples", with_ctes(["rating"], [], "SELECT uid, mid, score FROM rating"))
def q_rating_triples(spark, sf):
    return stats.rating_triples(load_inputs(spark, sf).ratings)


@register("movie_text_parse", with_ctes(["movie"], [], """
SELECT mid, trim(name) AS name, trim(descri) AS descri, trim(timelong) AS timelong, trim(issue) AS issue,
       trim(shoot) AS shoot, trim(language) AS language, trim(genres) AS genres, trim(actors) AS actors,
       trim(directors) AS directors FROM movie"""))
def q_movie_text_parse(spark, sf):
    return text.parse_movies(text.movie_lines(load_inputs(spark, sf).movies))


@register("rating_text_parse", with_ctes(["rating"], [], "SELECT * FROM rating"))
def q_rating_text_parse(spark, sf):
    return text.parse_ratings(text.rating_lines(load_inputs(spark, sf).ratings))


@register("tag_text_parse", with_ctes(["tag"], [],
                                      'SELECT uid, mid, trim(tag) AS tag, "timestamp" FROM tag'))
def q_tag_text_parse(spark, sf):
    return text.parse_tags(text.tag_lines(load_inputs(spark, sf).tags))


def _stored_base(spark, sf) -> dict[str, str]:
    inp = load_inputs(spark, sf)
    return tables.store_base_tables(inp.movies, inp.ratings, inp.tags, scratch_path(spark, "base"), user_buckets=16)


@register("table_roundtrip", with_ctes(["rating"], [], "SELECT * FROM rating"))
def q_table_roundtrip(spark, sf):
    return tables.read_ratings(spark, _stored_base(spark, sf)["rating"])


@register("table_roundtrip_movies", with_ctes(["movie"], [], "SELECT * FROM movie"))
def q_table_roundtrip_movies(spark, sf):
    return tables.read_movies(spark, _stored_base(spark, sf)["movie"])


@register("table_roundtrip_tags", with_ctes(["tag"], [], "SELECT * FROM tag"))
def q_table_roundtrip_tags(spark, sf):
    return tables.read_tags(spark, _stored_base(spark, sf)["tag"])


@register("recent_list_parse", with_ctes(["rating"], [], """
SELECT uid, CAST(rn - 1 AS INT) AS pos, mid, score FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid ASC, score DESC) AS rn FROM rating)
WHERE rn <= 20"""))
def q_recent_list_parse(spark, sf):
    """The recent lists written as ``mid:score`` entries and read back."""
    recents = realtime.recent_ratings(load_inputs(spark, sf).ratings, 20)
    return text.parse_recents(text.recent_entries(recents))


@register("user_rating_lookup", with_ctes(["rating", "rating_event"], [], """
SELECT * FROM rating WHERE uid IN (SELECT uid FROM rating_event)"""))
def q_user_rating_lookup(spark, sf):
    inp = load_inputs(spark, sf)
    return stats.user_ratings(inp.ratings, inp.rating_events)


# ---------------------------------------------------------------- tags / documents

_TAGS_SQL = "tags_of AS (SELECT mid, string_agg(tag, '|' ORDER BY tag) AS tags FROM (SELECT DISTINCT mid, tag FROM tag) GROUP BY mid)"


@register("movie_tags_concat", with_ctes(["tag"], [_TAGS_SQL], "SELECT mid, tags FROM tags_of"))
def q_movie_tags_concat(spark, sf):
    return stats.movie_tags(load_inputs(spark, sf).tags)


@register("movies_with_tags", with_ctes(["movie", "tag"], [_TAGS_SQL],
                                        "SELECT movie.*, tags_of.tags FROM movie LEFT JOIN tags_of USING (mid)"))
def q_movies_with_tags(spark, sf):
    inp = load_inputs(spark, sf)
    return stats.movies_with_tags(inp.movies, inp.tags)


@register("search_documents", with_ctes(["movie", "tag"], [_TAGS_SQL], """
SELECT CAST(movie.mid AS VARCHAR) AS doc_id, movie.*, tags_of.tags
FROM movie LEFT JOIN tags_of USING (mid)"""))
def q_search_documents(spark, sf):
    inp = load_inputs(spark, sf)
    return tables.search_documents(stats.movies_with_tags(inp.movies, inp.tags))


# ---------------------------------------------------------------- statistics

@register("rate_more_movies", with_ctes(["rating"], [],
                                        'SELECT mid, count(mid) AS "count" FROM rating GROUP BY mid'))
def q_rate_more_movies(spark, sf):
    return stats.rate_more_movies(load_inputs(spark, sf).ratings)


@register("rate_more_recently", with_ctes(["rating"], [], """
SELECT mid, count(mid) AS "count", yearmonth FROM (
  SELECT mid, strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m') AS yearmonth FROM rating)
GROUP BY yearmonth, mid"""))
def q_rate_more_recently(spark, sf):
    return stats.rate_more_recently(load_inputs(spark, sf).ratings)


@register("rate_more_recently_order", with_ctes(["rating"], [], """
SELECT yearmonth, CAST(row_number() OVER (PARTITION BY yearmonth ORDER BY "count" DESC, mid ASC) AS INT) AS place,
       mid, "count" FROM (
  SELECT mid, count(mid) AS "count", yearmonth FROM (
    SELECT mid, strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m') AS yearmonth FROM rating)
  GROUP BY yearmonth, mid)"""))
def q_rate_more_recently_order(spark, sf):
    """The ordered listing: a movie's place in its month, as the sorted rows (written in order) have it."""
    ordered = stats.rate_more_recently(load_inputs(spark, sf).ratings, ordered=True)
    path = scratch_path(spark, "recently")
    ordered.withColumn("line", F.monotonically_increasing_id()).write.parquet(path)  # sorted partitions, in order
    month = Window.partitionBy("yearmonth").orderBy("line")
    return spark.read.parquet(path).select("yearmonth", F.row_number().over(month).alias("place"), "mid", "count")


_AVG_SQL = 'avgm AS (SELECT mid, avg(score) AS "avg" FROM rating GROUP BY mid)'


@register("average_movies", with_ctes(["rating"], [_AVG_SQL], "SELECT * FROM avgm"))
def q_average_movies(spark, sf):
    return stats.average_movies(load_inputs(spark, sf).ratings)


@register("movies_with_avg", with_ctes(["movie", "rating"], [_AVG_SQL],
                                       'SELECT movie.*, avgm."avg" FROM movie JOIN avgm USING (mid)'))
def q_movies_with_avg(spark, sf):
    inp = load_inputs(spark, sf)
    return stats.movies_with_avg(inp.movies, stats.average_movies(inp.ratings))


def _genre_values() -> str:
    return "genre_list AS (SELECT * FROM (VALUES " + ", ".join(f"('{g}')" for g in FIXTURE_GENRES) + ") t(genre))"


_MATCH_SQL = """matched AS (
  SELECT g.genre, m.mid, a."avg" FROM genre_list g JOIN movie m ON contains(lower(m.genres), lower(g.genre))
  JOIN avgm a ON a.mid = m.mid)"""


@register("genre_match", with_ctes(["movie", "rating"], [_AVG_SQL, _genre_values(), _MATCH_SQL],
                                   'SELECT genre, mid, "avg" FROM matched'))
def q_genre_match(spark, sf):
    inp = load_inputs(spark, sf)
    mwa = stats.movies_with_avg(inp.movies, stats.average_movies(inp.ratings))
    return stats.genre_movies(mwa, FIXTURE_GENRES)


@register("genres_top_movies", with_ctes(["movie", "rating"], [_AVG_SQL, _genre_values(), _MATCH_SQL], """
SELECT genre AS genres, CAST(rank AS INT) AS rank, mid, "avg" AS score FROM (
  SELECT genre, mid, "avg", row_number() OVER (PARTITION BY genre ORDER BY "avg" DESC, mid ASC) AS rank
  FROM matched) WHERE rank <= 10"""))
def q_genres_top_movies(spark, sf):
    return stats.flatten_recs(genres_top_movies_lists(spark, sf), "genres")


def genres_top_movies_lists(spark: SparkSession, sf: str) -> DataFrame:
    inp = load_inputs(spark, sf)
    mwa = stats.movies_with_avg(inp.movies, stats.average_movies(inp.ratings))
    return stats.genres_top_movies(mwa, FIXTURE_GENRES, k=10)


@register("distinct_users", with_ctes(["rating"], [], "SELECT DISTINCT uid FROM rating"))
def q_distinct_users(spark, sf):
    return stats.distinct_users(load_inputs(spark, sf).ratings)


@register("distinct_movies", with_ctes(["rating"], [], "SELECT DISTINCT mid FROM rating"))
def q_distinct_movies(spark, sf):
    return stats.distinct_movies(load_inputs(spark, sf).ratings)


# ---------------------------------------------------------------- content similarity


@register("genre_tokens", with_ctes(["movie"], CONTENT_CTES[:1],
                                    "SELECT mid, CAST(pos - 1 AS INT) AS pos, token FROM tok"))
def q_genre_tokens(spark, sf):
    return content.genre_tokens(load_inputs(spark, sf).movies)


@register("hashed_tf", with_ctes(["movie"], CONTENT_CTES[:3], "SELECT mid, CAST(term AS INT) AS term, tf FROM tf"))
def q_hashed_tf(spark, sf):
    return content.hashed_tf(load_inputs(spark, sf).movies)


@register("idf_weights", with_ctes(["movie"], CONTENT_CTES[:4],
                                   "SELECT CAST(term AS INT) AS term, df, round(idf, 9) AS idf FROM idf"))
def q_idf_weights(spark, sf):
    idf = content.idf_weights(load_inputs(spark, sf).movies)
    return idf.select("term", "df", F.round("idf", 9).alias("idf"))


@register("tfidf_weights", with_ctes(["movie"], CONTENT_CTES[:5],
                                     "SELECT mid, CAST(term AS INT) AS term, tf, round(w, 9) AS weight FROM w"))
def q_tfidf_weights(spark, sf):
    w = content.tfidf_weights(load_inputs(spark, sf).movies)
    return w.select("mid", "term", "tf", F.round("weight", 9).alias("weight"))


@register("content_sim_pairs", with_ctes(["movie"], CONTENT_CTES,
                                         "SELECT mid, other_mid, round(score, 6) AS score FROM sims"))
def q_content_sim_pairs(spark, sf):
    return content.content_sim_pairs(load_inputs(spark, sf).movies, digits=6)


@register("content_movie_recs", with_ctes(["movie"], CONTENT_CTES, """
SELECT mid, CAST(row_number() OVER (PARTITION BY mid ORDER BY score DESC, other_mid ASC) AS INT) AS rank,
       other_mid, round(score, 6) AS score FROM sims"""))
def q_content_movie_recs(spark, sf):
    recs = content.content_movie_recs(load_inputs(spark, sf).movies, digits=6)
    return content.similarity_entries(recs).select("mid", "rank", "other_mid", "score")


@register("tfidf_weights_exact", with_ctes(["movie"], EXACT_CTES[:4],
                                           "SELECT mid, term, tf, round(w, 9) AS weight FROM w"))
def q_tfidf_weights_exact(spark, sf):
    w = content.tfidf_weights(load_inputs(spark, sf).movies, term_space="exact")
    return w.select("mid", "term", "tf", F.round("weight", 9).alias("weight"))


@register("content_sim_pairs_exact", with_ctes(["movie"], EXACT_CTES,
                                               "SELECT mid, other_mid, round(score, 6) AS score FROM sims"))
def q_content_sim_pairs_exact(spark, sf):
    return content.content_sim_pairs(load_inputs(spark, sf).movies, term_space="exact", digits=6)


# ---------------------------------------------------------------- real-time scoring (batch form)


_RT = ["movie", "rating", "rating_event"]
STRICT_SIM = 0.97


def _rt_inputs(spark, sf):
    """Inputs and the stored similarities, factored by class, as the real-time job reads them."""
    inp, root = load_inputs(spark, sf), scratch_path(spark, "content")
    model = content.content_model(inp.movies)
    FactoredSims.of(model).write(root)
    model.unpersist()
    return inp, FactoredSims.read(spark, root, model.threshold)


def _rt_ratings(spark, sf) -> DataFrame:
    """The rating table as the real-time job finds it: stored, so that its order lines are joined once for all reads."""
    return written(load_inputs(spark, sf).ratings, "ratings")


def _rt_sql(n_ctes: int, body: str) -> str:
    return with_ctes(_RT, CONTENT_CTES + REALTIME_CTES[:n_ctes], body)


@register("sim_flatten", with_ctes(["movie"], CONTENT_CTES,
                                   "SELECT mid, other_mid, round(score, 6) AS score FROM sims"))
def q_sim_flatten(spark, sf):
    """Store the per-movie lists, read them back, flatten to the lookup table."""
    recs = content.content_movie_recs(load_inputs(spark, sf).movies, digits=6)
    path = scratch_path(spark, "content_movie_recs")
    tables.write_table(recs, path)
    return content.similarity_entries(tables.read_table(spark, path)).select("mid", "other_mid", "score")


@register("user_recent_ratings", with_ctes(["rating"], [], """
SELECT uid, CAST(rn - 1 AS INT) AS pos, mid, score, "timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid ASC, score DESC) AS rn FROM rating)
WHERE rn <= 20"""))
def q_user_recent_ratings(spark, sf):
    return realtime.recent_ratings(load_inputs(spark, sf).ratings, 20)


@register("unseen_candidates", _rt_sql(2, "SELECT uid, mid, round(sim, 6) AS sim FROM unseen"))
def q_unseen_candidates(spark, sf):
    inp, sims = _rt_inputs(spark, sf)
    out = realtime.unseen_candidates(realtime.last_events(inp.rating_events), sims, inp.ratings)
    return out.select("uid", "mid", F.round("sim", 6).alias("sim"))


@register("top_sim_movies", _rt_sql(3, "SELECT uid, CAST(rank AS INT) AS rank, mid, round(sim, 6) AS sim FROM topsim"))
def q_top_sim_movies(spark, sf):
    inp, sims = _rt_inputs(spark, sf)
    out = realtime.top_sim_movies(realtime.last_events(inp.rating_events), sims, inp.ratings, 20)
    return out.select("uid", "rank", "mid", F.round("sim", 6).alias("sim"))


def _rt_pairs(spark, sf):
    inp, sims = _rt_inputs(spark, sf)
    ratings = _rt_ratings(spark, sf)
    last = written(realtime.last_events(inp.rating_events), "last_events")
    cands = realtime.top_sim_movies(last, sims, ratings, 20)
    recents = realtime.batch_recents(inp.rating_events, ratings, 20)
    return realtime.candidate_pairs(cands, recents, sims)


@register("sim_lookup", _rt_sql(6, """
SELECT uid, mid, recent_mid, recent_score, round(sim, 6) AS sim FROM cpairs"""))
def q_sim_lookup(spark, sf):
    return _rt_pairs(spark, sf).withColumn("sim", F.round("sim", 6))


@register("boost_counts", _rt_sql(7, "SELECT uid, mid, round(base, 6) AS base, incr, decr FROM boost"))
def q_boost_counts(spark, sf):
    out = realtime.boost_counts(_rt_pairs(spark, sf), 0.7)
    return out.withColumn("base", F.round("base", 6))


_FINAL = "SELECT uid, rank, mid, round(score, 6) AS score FROM ranked"


@register("stream_scores_strict", _rt_sql(10, """
SELECT uid, coalesce(rank, 0) AS rank, coalesce(mid, -1) AS mid, coalesce(round(score, 6), 0.0) AS score
FROM ranked""").replace("sim > 0.7", f"sim > {STRICT_SIM}"))
def q_stream_scores_strict(spark, sf):
    """Scoring with a similarity threshold so high that many users' lists are empty: they keep
    their row (written here with rank 0 and movie -1 in place of NULLs)."""
    inp, sims = _rt_inputs(spark, sf)
    recs = realtime.realtime_recs(inp.rating_events, _rt_ratings(spark, sf), sims, threshold=STRICT_SIM)
    return stats.flatten_recs(recs, "uid").select(
        "uid", F.coalesce("rank", F.lit(0)).alias("rank"), F.coalesce("mid", F.lit(-1)).alias("mid"),
        F.coalesce(F.round("score", 6), F.lit(0.0)).alias("score"))


@register("stream_scores", _rt_sql(10, _FINAL))
def q_stream_scores(spark, sf):
    inp, sims = _rt_inputs(spark, sf)
    recs = realtime.realtime_recs(inp.rating_events, _rt_ratings(spark, sf), sims)
    flat = stats.flatten_recs(recs, "uid")
    return flat.withColumn("score", F.round("score", 6))


@register("recs_upsert", _rt_sql(10, _FINAL))
def q_recs_upsert(spark, sf):
    """The events as two micro-batches split at the middle of their time span, both
    written to the stored table: the second batch's lists replace the first's, user by
    user.  The committed version must equal one batch over all events."""
    inp, sims = _rt_inputs(spark, sf)
    ev, ratings = inp.rating_events, _rt_ratings(spark, sf)
    mid_ts = ev.select((F.min("timestamp").cast("bigint") + F.max("timestamp")) / 2).scalar()
    first, second = ev.filter(F.col("timestamp") <= mid_ts), ev.filter(F.col("timestamp") > mid_ts)
    table = streaming.UserLog(spark, scratch_path(spark, "recs_upsert"))
    table.write(realtime.realtime_recs(first, ratings, sims), 0)
    table.write(realtime.realtime_recs(second, ratings.unionByName(first), sims, rated=ratings), 1)
    return stats.flatten_recs(table.latest(), "uid").withColumn("score", F.round("score", 6))


# ---------------------------------------------------------------- streaming


@register("stream_parse", with_ctes(["rating_event"], [], "SELECT * FROM rating_event"))
def q_stream_parse(spark, sf):
    msgs = fixtures.rating_messages(load_inputs(spark, sf).rating_events)
    return streaming.parse_rating_messages(msgs)


@register("stream_recs", _rt_sql(10, _FINAL))
def q_stream_recs(spark, sf):
    """The event table written as message files, in order, and consumed by the streaming
    query (file source, availableNow); the result is the StreamRecs table."""
    inp, sims = _rt_inputs(spark, sf)
    src = scratch_path(spark, "stream_in")
    events = inp.rating_events.repartitionByRange("timestamp").sortWithinPartitions("timestamp")
    fixtures.rating_messages(events).write.text(src)
    past = scratch_path(spark, "stream_history")
    UserHistory.write(_rt_ratings(spark, sf), past)
    sink, ckpt = scratch_path(spark, "stream_recs"), scratch_path(spark, "stream_ckpt")
    q = streaming.start_realtime_query(spark, streaming.rating_stream(spark, "text", src), UserHistory.read(spark, past), sims,
                                       sink, ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    return stats.flatten_recs(streaming.current_stream_recs(spark, sink), "uid").withColumn(
        "score", F.round("score", 6))


# ---------------------------------------------------------------- latent factors


_SPLIT_SQL = """split AS (SELECT *, CASE WHEN ((((CAST(uid AS BIGINT) * 1000003 + mid) % 2147483647) * 1000003
  + "timestamp") % 2147483647) % 10 < 8 THEN 'train' ELSE 'test' END AS split FROM rating)"""


@register("rating_split", with_ctes(["rating"], [_SPLIT_SQL], "SELECT * FROM split"))
def q_rating_split(spark, sf):
    return latent.rating_split(load_inputs(spark, sf).ratings)


@register("rmse", with_ctes(["rating"], [_SPLIT_SQL], """
SELECT round(sqrt(avg((p.prediction - t.score) * (p.prediction - t.score))), 9) AS rmse
FROM (SELECT * FROM split WHERE split = 'test') t
JOIN (SELECT mid, avg(score) AS prediction FROM split WHERE split = 'train' GROUP BY mid) p USING (mid)"""))
def q_rmse(spark, sf):
    s = latent.rating_split(load_inputs(spark, sf).ratings)
    preds = latent.movie_mean_predictions(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test"))
    return latent.rmse(preds).select(F.round("rmse", 9).alias("rmse"))


def _als_model(spark, sf):
    return latent.fit_als(written(stats.rating_triples(load_inputs(spark, sf).ratings), "als_ratings"))


def _stored_split(spark, sf) -> DataFrame:
    """The split, made and written once: it is counted, fitted and tested on."""
    return written(latent.rating_split(load_inputs(spark, sf).ratings), "als_split")


# The factors themselves depend on summation order, so the checks are facts that hold for any fit: who gets a list, of
# how many different ids, in falling order; which pairs are predicted; which grid is searched.


def _list_facts(recs: DataFrame, key: str, id_field: str) -> DataFrame:
    ids, scores = F.col(f"recs.{id_field}"), F.col("recs.score")
    falling = F.forall(F.sequence(F.lit(1), F.greatest(F.size("recs") - 1, F.lit(1))), lambda i: F.coalesce(
        F.try_element_at(scores, i) >= F.try_element_at(scores, i + 1), F.lit(True)))
    return recs.select(key, F.size("recs").alias("n_recs"), F.size(F.array_distinct(ids)).alias("n_distinct"),
                       falling.alias("falling"))


def _list_facts_sql(key: str, other: str) -> str:
    return with_ctes(["rating"], [], f"""
SELECT {key}, least(50, (SELECT count(DISTINCT {other}) FROM rating))::INT AS n_recs,
       least(50, (SELECT count(DISTINCT {other}) FROM rating))::INT AS n_distinct, true AS falling
FROM (SELECT DISTINCT {key} FROM rating)""")


@register("als_user_recs", _list_facts_sql("uid", "mid"))
def q_als_user_recs(spark, sf):
    return _list_facts(latent.user_recs(_als_model(spark, sf), 50), "uid", "mid")


@register("als_item_recs", _list_facts_sql("mid", "uid"))
def q_als_item_recs(spark, sf):
    return _list_facts(latent.item_recs(_als_model(spark, sf), 50), "mid", "uid")


@register("als_predict", with_ctes(["rating"], [_SPLIT_SQL], """
SELECT uid, mid, score, true AS finite FROM split
WHERE split = 'test' AND uid IN (SELECT uid FROM split WHERE split = 'train')
  AND mid IN (SELECT mid FROM split WHERE split = 'train')"""))
def q_als_predict(spark, sf):
    s = _stored_split(spark, sf)
    model = latent.fit_als(s.filter(F.col("split") == "train"))
    found = latent.predict(model, s.filter(F.col("split") == "test"))
    finite = ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    return found.select("uid", "mid", "score", finite.alias("finite"))


@register("als_grid_best", """
SELECT 4 AS points, true AS rank_in_grid, true AS alpha_in_grid, 0.1::DOUBLE AS reg_param, true AS least, true AS finite""")
def q_als_grid_best(spark, sf):
    s = _stored_split(spark, sf)
    grid = latent.als_grid(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test"))
    least = grid.agg(F.min("rmse").alias("least"), F.count("*").cast("int").alias("points"))
    best = latent.best_params(grid)
    joined = best.join(least, best["rmse"] == least["least"])
    return joined.select(
        "points", F.col("rank").isin(50, 100).alias("rank_in_grid"), F.col("alpha").isin(0.01, 0.02).alias("alpha_in_grid"),
        "reg_param", (F.col("rmse") <= F.col("least")).alias("least"), (F.col("rmse") < float("inf")).alias("finite"))


@register("tfidf_vectors", with_ctes(["movie"], CONTENT_CTES[:5], """
SELECT mid, CAST(term AS INT) AS slot, round(w, 9) AS weight FROM w WHERE w != 0"""))
def q_tfidf_vectors(spark, sf):
    """The dense vectors' slots that are not zero (every vector has all 50 slots, see the tests)."""
    dense = content.tfidf_vectors(load_inputs(spark, sf).movies)
    return (dense.select("mid", F.posexplode("features").alias("slot", "w")).where(F.col("w") != 0)
            .select("mid", "slot", F.round("w", 9).alias("weight")))
