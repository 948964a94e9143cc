from reelrank.operators import stats
from reelrank.functions.columns import year_month


def movies(spark):
    rows = [(1, "Action|Cold War"), (2, "Comedy|Drama"), (3, "Old Western"), (4, "Drama"), (5, "Animation")]
    return spark.createDataFrame(rows, "mid int, genres string")


def test_year_month_utc(spark):
    df = spark.createDataFrame([(1260759144,)], "t int")
    assert df.select(year_month("t").alias("ym")).first().ym == "200912"


def test_genre_match_is_substring_by_default(spark):
    m = movies(spark)
    mwa = m.withColumn("avg", m.mid.cast("double"))
    got = {(r.genre, r.mid) for r in stats.genre_movies(mwa, ["Old", "Drama", "Western", "War"]).collect()}
    assert ("Old", 1) in got  # 'cold' contains 'old'
    assert ("War", 1) in got  # 'cold war'
    assert ("Western", 3) in got and ("Drama", 2) in got and ("Drama", 4) in got
    tok = {(r.genre, r.mid) for r in stats.genre_movies(mwa, ["Old"], match="token").collect()}
    assert tok == set()


def test_genres_top_movies_order_and_ties(spark):
    rows = [(m, "Drama", a) for m, a in [(1, 3.0), (2, 4.0), (3, 4.0), (4, 1.0), (5, 5.0)]]
    mwa = spark.createDataFrame(rows, "mid int, genres string, avg double")
    out = stats.genres_top_movies(mwa, ["Drama", "Horror"], k=3).collect()
    assert len(out) == 1  # no Horror row
    assert [(r.mid, r.score) for r in out[0].recs] == [(5, 5.0), (2, 4.0), (3, 4.0)]


def test_counts_and_averages(spark):
    r = spark.createDataFrame([(1, 10, 4.0, 0), (2, 10, 2.0, 0), (1, 11, 5.0, 2678400)],
                              "uid int, mid int, score double, timestamp int")
    assert {(x.mid, x["count"]) for x in stats.rate_more_movies(r).collect()} == {(10, 2), (11, 1)}
    assert {(x.mid, x.avg) for x in stats.average_movies(r).collect()} == {(10, 3.0), (11, 5.0)}
    rec = {(x.yearmonth, x.mid, x["count"]) for x in stats.rate_more_recently(r).collect()}
    assert rec == {("197001", 10, 2), ("197002", 11, 1)}
    ordered = [x.yearmonth for x in stats.rate_more_recently(r, ordered=True).collect()]
    assert ordered == ["197002", "197001"]


def test_movie_tags_sorted_distinct_and_left_join(spark):
    tags = spark.createDataFrame([(1, 1, "b", 0), (2, 1, "a", 0), (3, 1, "b", 0)],
                                 "uid int, mid int, tag string, timestamp int")
    m = spark.createDataFrame([(1, "x"), (2, "y")], "mid int, name string")
    got = {r.mid: r.tags for r in stats.movies_with_tags(m, tags).collect()}
    assert got == {1: "a|b", 2: None}


def test_movies_with_avg_drops_unrated(spark):
    m = spark.createDataFrame([(1, "x"), (2, "y")], "mid int, name string")
    a = spark.createDataFrame([(1, 3.5)], "mid int, avg double")
    assert [r.mid for r in stats.movies_with_avg(m, a).collect()] == [1]
