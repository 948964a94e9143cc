"""Hot keys: one user and one movie each hold a third of all ratings."""

import pandas as pd
from pyspark.sql import functions as F

from reelrank.operators import content, realtime, stats
from reelrank.operators.factored import FactoredSims


def skewed(spark, n=30000):
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0
    return ids.select(
        F.when(hot, F.lit(7)).otherwise((F.col("id") % 997).cast("int")).alias("uid"),
        F.when(F.col("id") % 3 == 1, F.lit(42)).otherwise((F.col("id") % 1009).cast("int")).alias("mid"),
        ((F.col("id") % 10 + 1) / 2).cast("double").alias("score"),
        (F.col("id") * 37 % 100000).cast("int").alias("timestamp"))


def test_aggregates_and_top_k_on_hot_keys(spark):
    r = skewed(spark)
    pdf = r.toPandas()
    counts = {x.mid: x["count"] for x in stats.rate_more_movies(r).collect()}
    assert counts == pdf.groupby("mid").size().to_dict()
    means = {x.mid: x.avg for x in stats.average_movies(r).collect()}
    want = pdf.groupby("mid")["score"].mean().to_dict()
    assert all(abs(means[m] - v) < 1e-9 for m, v in want.items())

    recent = realtime.recent_ratings(r, 20).filter("uid = 7").orderBy("pos").collect()
    hot = pdf[pdf.uid == 7].sort_values(["timestamp", "mid", "score"], ascending=[False, True, False]).head(20)
    assert [(x.mid, x.timestamp) for x in recent] == list(zip(hot.mid, hot.timestamp))

    last = {x.uid: (x.timestamp, x.mid, x.score) for x in realtime.last_events(r).collect()}
    best = pdf.sort_values(["timestamp", "mid", "score"]).groupby("uid").tail(1)
    assert last == {u: (t, m, s) for u, t, m, s in zip(best.uid, best.timestamp, best.mid, best.score)}


def test_tag_string_of_a_hot_movie(spark):
    tags = skewed(spark).select("uid", "mid", (F.col("uid") % 5).cast("string").alias("tag"), "timestamp")
    got = {x.mid: x.tags for x in stats.movie_tags(tags).filter("mid = 42").collect()}
    pdf = tags.filter("mid = 42").toPandas()
    assert got == {42: "|".join(sorted(pd.unique(pdf.tag)))}


def hot_movies(spark, n=1500):
    """A third of all movies share one genre string, the others have many."""
    ids = spark.range(n)
    return ids.select(F.col("id").cast("int").alias("mid"), F.when(F.col("id") % 3 == 0, F.lit("Drama|Rare")).otherwise(
        F.concat_ws("|", F.concat(F.lit("g"), F.col("id") % 17), F.concat(F.lit("h"), F.col("id") % 41))).alias("genres"))


def test_pairs_of_a_hot_class_are_spread_evenly(spark):
    movies = hot_movies(spark)
    model = content.content_model(movies)
    pairs = model.pairs().withColumn("task", F.spark_partition_id())
    made = [r["count"] for r in pairs.groupBy("task").count().collect()]
    assert sum(made) >= 500 * 499 and max(made) <= 2 * sum(made) / max(len(made), 4)
    assert model.pairs().select("mid", "other_mid").distinct().count() == sum(made)
    model.unpersist()


def test_factored_lists_of_a_hot_class_equal_the_expanded_ones(spark, tmp_dir):
    movies = hot_movies(spark, 600)
    model = content.content_model(movies)
    FactoredSims.of(model).write(tmp_dir)
    sims = FactoredSims.read(spark, tmp_dir, model.threshold)
    assert {r.pos for r in sims.members.where("cid = 0").collect()} == set(range(200))
    wanted = movies.select(F.col("mid").alias("uid"), F.col("mid").alias("src"), (F.col("mid") % 130 + 1).alias("limit"))
    full: dict = {}
    for r in model.recs().orderBy("mid", "chunk_no").collect():
        full.setdefault(r.mid, []).extend((x.score, x.mid) for x in r.recs)
    got: dict = {}
    for r in sims.head(wanted).collect():
        got.setdefault(r.uid, []).append((r.sim, r.mid))
    for w in wanted.collect():
        head = sorted(got.get(w.uid, []), key=lambda x: (-x[0], x[1]))[:w.limit]
        assert head == full.get(w.src, [])[:w.limit]
    stored = {(r.mid, r.other_mid): r.score for r in model.pairs().collect()}
    candidates = movies.limit(40).select(F.lit(1).alias("uid"), "mid")
    recents = movies.limit(60).select(F.lit(1).alias("uid"), F.col("mid").alias("recent_mid"), F.lit(2.0).alias("recent_score"))
    recents = recents.unionByName(spark.createDataFrame([(1, -5, 1.0)], "uid int, recent_mid int, recent_score double"))
    scored = sims.scored(candidates, recents).collect()
    assert len(scored) == 40 * 61
    for r in scored:
        assert r.sim == stored.get((r.mid, r.recent_mid), 0.0)
    model.unpersist()


def test_list_store_of_a_hot_class_is_chunked(spark, monkeypatch):
    """A third of all movies in one class: no array beyond a chunk, ranks without gaps, the rows of the pairs."""
    movies = hot_movies(spark, 900).unionByName(spark.createDataFrame(  # classes of equal similarity to others: ties
        [(9000 + i, g) for i in range(40) for g in [f"t{i % 2}|common|shared"]], "mid int, genres string"))
    model = content.content_model(movies)
    stored = model.lists(size=50).persist()
    assert stored.agg(F.max(F.size("recs"))).first()[0] <= 50
    assert stored.where("mid = 0").count() >= 300 // 50
    got: dict = {}
    for r in content.similarity_entries(stored).orderBy("mid", "rank").collect():
        got.setdefault(r.mid, []).append((r.rank, r.score, r.other_mid))
    want: dict = {}
    for r in model.pairs().collect():
        want.setdefault(r.mid, []).append((r.score, r.other_mid))
    assert got.keys() == want.keys()
    for mid, pairs in want.items():
        ordered = sorted(pairs, key=lambda x: (-x[0], x[1]))
        assert got[mid] == [(i, *p) for i, p in enumerate(ordered, 1)]
    # one movie's head is read from its first chunks alone
    head = stored.where("mid = 3 AND first <= 60")
    assert head.count() == 2
    stored.unpersist()
    model.unpersist()
