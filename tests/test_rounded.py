"""``functions.rounded`` gives the bits of ``round``, without its decimal objects."""

from pyspark.sql import functions as F

from reelrank.functions.columns import rounded
from reelrank.operators import content


def test_same_bits_as_round(spark):
    odd = "array(double('nan'), double('inf'), -double('inf'), -0.0D, 1e20D, -1e-9D, cast(null as double), 999.9999995D, 1000.0000005D)"
    x = (spark.range(40001).selectExpr("(id - 20000) * 0.0000005D AS x").union(spark.range(20000).select(F.rand(1).alias("x")))
         .union(spark.sql(f"SELECT explode({odd}) AS x")))
    assert x.where(~rounded("x").eqNullSafe(F.round("x", 6))).isEmpty()


def test_pair_queries_round_no_decimals_away_from_ties(spark):
    """The plan of a rounded column decides by plain arithmetic first."""
    plan = spark.range(1).select(rounded(F.col("id").cast("double")))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "FLOOR" in plan.upper()


def test_lists_filter_only_the_chunks_that_hold_the_movie(spark):
    """Movies that come twice leave all their rows out of their own list; the others keep theirs."""
    rows = [(1, "a|b"), (1, "a|b"), (2, "a|b"), (3, "a|b"), (4, "c"), (5, "d|e"), (6, "d|e")]
    movies = spark.createDataFrame(rows, "mid int, genres string")
    lists = content.content_movie_recs(movies, term_space="exact").collect()
    got = sorted((r.mid, tuple(e.mid for e in r.recs)) for r in lists)
    assert got == [(1, (2, 3)), (1, (2, 3)), (2, (1, 1, 3)), (3, (1, 1, 2)), (5, (6,)), (6, (5,))]
