"""The jobs end to end on the small fixture: text files in, tables out."""

from pyspark.sql import functions as F

from reelrank.operators import latent
from reelrank.plans import jobs
from reelrank.plans.catalog import FIXTURE_GENRES
from reelrank.sources import fixtures, tables, text
from reelrank.streaming import current_stream_recs, rating_stream
from tests.conftest import SF_SMALL


def test_jobs_end_to_end(spark, tmp_dir):
    inp = fixtures.load_inputs(spark, SF_SMALL)
    text.movie_lines(inp.movies).write.text(f"{tmp_dir}/txt/movies")
    text.rating_lines(inp.ratings).write.text(f"{tmp_dir}/txt/ratings")
    text.tag_lines(inp.tags).write.text(f"{tmp_dir}/txt/tags")

    base = jobs.load_job(spark, f"{tmp_dir}/txt/movies", f"{tmp_dir}/txt/ratings", f"{tmp_dir}/txt/tags",
                         f"{tmp_dir}/base", search_path=f"{tmp_dir}/search")
    movies = tables.read_movies(spark, base["movie"])
    ratings = tables.read_ratings(spark, base["rating"])
    assert ratings.count() == inp.ratings.count()
    assert spark.read.json(base["search"]).count() == movies.count()

    out = jobs.statistics_job(movies, ratings, f"{tmp_dir}/stats", genres=FIXTURE_GENRES)
    avg = spark.read.parquet(out[jobs.AVERAGE_MOVIES])
    assert avg.columns == ["mid", "avg"]  # the averages, not the monthly counts
    top = spark.read.parquet(out[jobs.GENRES_TOP_MOVIES])
    assert top.count() > 0 and top.select(F.max(F.size("recs"))).first()[0] <= 10

    c = jobs.content_job(movies, f"{tmp_dir}/content", write_pairs=True, write_lists=True)
    pairs = spark.read.parquet(c[jobs.CONTENT_SIMILARITY])
    lists = spark.read.parquet(c[jobs.CONTENT_MOVIE_RECS])
    assert lists.select(F.sum(F.size("recs"))).first()[0] == pairs.count()
    capped = spark.read.parquet(jobs.content_job(movies, f"{tmp_dir}/content_k", k=5, write_lists=True)[jobs.CONTENT_MOVIE_RECS])
    assert capped.select(F.max(F.size("recs"))).first()[0] <= 5

    o = jobs.offline_job(ratings, f"{tmp_dir}/offline", latent.AlsParams(rank=4, max_iter=2), k=7)
    u = spark.read.parquet(o[jobs.USER_TO_MOVIE])
    assert u.count() == ratings.select("uid").distinct().count()
    assert u.select(F.max(F.size("recs"))).first()[0] == 7

    best = jobs.tuning_job(ratings, ranks=(2, 3), alphas=(0.01,), reg_params=(0.1,)).collect()
    assert len(best) == 1 and best[0].rank in (2, 3)

    src = f"{tmp_dir}/stream_in"
    fixtures.rating_messages(inp.rating_events).write.text(src)
    q = jobs.realtime_job(spark, rating_stream(spark, "text", src), ratings, f"{tmp_dir}/content",
                          f"{tmp_dir}/rt", f"{tmp_dir}/rt_ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    recs = current_stream_recs(spark, f"{tmp_dir}/rt/{jobs.STREAM_RECS}")
    assert recs.count() == inp.rating_events.select("uid").distinct().count()


def test_lenient_load_writes_bad_lines_out(spark, tmp_dir):
    def put(name, lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/{name}")

    put("m", ["1^a\t^b^c^d^e^f^ Action|War \x01^h^i", "x^a^b^c^d^e^f^g^h^i"])
    put("r", ["1,1,2.5,7", "1,1,bad,7", "1,2"])
    put("t", ["1,1,\tfun, really \x1f,9", "no tag"])
    import pytest
    with pytest.raises(Exception):
        jobs.load_job(spark, f"{tmp_dir}/m", f"{tmp_dir}/r", f"{tmp_dir}/t", f"{tmp_dir}/strict")
    out = jobs.load_job(spark, f"{tmp_dir}/m", f"{tmp_dir}/r", f"{tmp_dir}/t", f"{tmp_dir}/base", strict=False)
    movie = tables.read_movies(spark, out["movie"]).first()
    assert (movie.mid, movie.name, movie.genres) == (1, "a", "Action|War")
    assert [tuple(r) for r in tables.read_ratings(spark, out["rating"]).collect()] == [(1, 1, 2.5, 7)]
    assert [r.tag for r in tables.read_tags(spark, out["tag"]).collect()] == ["fun, really"]
    bad = {k: sorted(r.value for r in spark.read.text(out[f"rejected_{k}"]).collect()) for k in ("movie", "rating", "tag")}
    assert bad == {"movie": ["x^a^b^c^d^e^f^g^h^i"], "rating": ["1,1,bad,7", "1,2"], "tag": ["no tag"]}
