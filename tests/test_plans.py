"""Plan-shape checks: the properties the operators rely on at scale."""

import re

from reelrank.operators import content, realtime, stats
from reelrank.operators.factored import FactoredSims
from reelrank.plans.catalog import FIXTURE_GENRES
from reelrank.sources import fixtures
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_are_combined_before_the_shuffle(spark):
    p = plan(stats.rate_more_movies(fixtures.load_inputs(spark, SF_SMALL).ratings))
    assert p.count("HashAggregate") >= 2  # partial + final


def test_top_k_per_group_is_limited_before_the_shuffle(spark):
    inp = fixtures.load_inputs(spark, SF_SMALL)
    top = stats.genres_top_movies(stats.movies_with_avg(inp.movies, stats.average_movies(inp.ratings)),
                                  FIXTURE_GENRES, 10)
    p = plan(top)
    assert "WindowGroupLimit" in p and "Partial" in p
    p = plan(realtime.recent_ratings(inp.ratings, 20))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_genre_match_needs_no_join(spark):
    m = fixtures.load_inputs(spark, SF_SMALL).movies
    p = plan(stats.genre_movies(m.withColumn("avg", m.mid.cast("double")), FIXTURE_GENRES))
    assert "Join" not in p and "NestedLoop" not in p


def test_scans_are_pruned_and_filtered(spark):
    tags = fixtures.load_inputs(spark, SF_SMALL).tags
    p = tags._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" not in p and "l_linenumber" not in p  # not read for tags
    rare = fixtures.load_inputs(spark, SF_SMALL).ratings.where("uid = 3")
    assert "PushedFilters: [IsNotNull(o_custkey)" in rare._jdf.queryExecution().executedPlan().toString() or "o_custkey" in plan(rare)


def test_term_join_is_grid_salted_and_repartitioned(spark):
    model = content.content_model(fixtures.load_inputs(spark, SF_SMALL).movies)
    p = plan(model.candidate_pairs())
    assert p.count("hashpartitioning(term") >= 2  # both sides on (term, grid row, grid column)
    assert "gr#" in p and "gc#" in p
    model.unpersist()


def test_a_micro_batch_reads_no_pair_table(spark, tmp_dir):
    inp = fixtures.load_inputs(spark, SF_SMALL)
    FactoredSims.of(content.content_model(inp.movies)).write(tmp_dir)
    sims = FactoredSims.read(spark, tmp_dir, 0.6)
    events = inp.rating_events.persist()
    p = plan(realtime.realtime_recs(events, inp.ratings, sims))
    scans = {x.split("/")[-1].rstrip("],. ") for x in re.findall(r"InMemoryFileIndex\([^)]*\)\[[^\]]*", p)}
    assert {"ContentMembers", "ContentVectors", "ContentHeads"} <= scans and "ContentSimilarity" not in p
    heads = p[p.index("ContentHeads"):]
    assert "PartitionFilters: [isnotnull(band" in heads and "band" in heads[:600]  # only the bands that can matter
    events.unpersist()


def test_array_work_is_not_repeated_by_inferred_filters(spark):
    # a plain explode would make Spark infer size(array) > 0 and push it into
    # the scan, evaluating the whole tokenizer/term-count expression again
    movies = fixtures.load_inputs(spark, SF_SMALL).movies
    for df in (content.hashed_tf(movies), content.genre_tokens(movies)):
        p = plan(df)
        assert "DataFilters: [(size(" not in p and "Filter (size(" not in p


def test_the_tokenizer_is_not_repeated(spark):
    """No filter of the plan holds the tokenizer, as the size test that Spark infers for a plain explode would, and the
    movies are dealt over the tasks before it."""
    movies = fixtures.load_inputs(spark, SF_SMALL).movies
    for df in (content.idf_weights(movies), content.tfidf_weights(movies), content.tfidf_weights(movies, term_space="exact")):
        tree = df._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in tree.splitlines() if "Filter" in line and ("regexp_replace" in line or "lambda" in line)]
        assert "RoundRobinPartitioning" in plan(df)
    stored = content.tfidf_vectors(movies)
    assert "regexp_replace" not in plan(stored) and "movie_terms" in "".join(stored.inputFiles())


def test_unseen_candidates_shuffle_classes_not_movies(spark, tmp_dir):
    inp = fixtures.load_inputs(spark, SF_SMALL)
    model = content.content_model(inp.movies)
    FactoredSims.of(model).write(tmp_dir)
    sims = FactoredSims.read(spark, tmp_dir, model.threshold)
    p = plan(realtime.unseen_candidates(realtime.last_events(inp.rating_events), sims, inp.ratings))
    assert "LeftAnti" not in p and not re.search(r"hashpartitioning\(uid#\d+L?, mid#\d+", p)
