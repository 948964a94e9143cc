import random

import pytest
from pyspark.sql import functions as F

from reelrank.operators import content
from reelrank.sources import fixtures
from tests import brute
from tests.conftest import SF_SMALL

WORDS = ["action", "drama", "war", "cold", "Old", "sci-fi", "noir", "kids"]


def random_movies(seed: int, n: int = 120):
    rnd = random.Random(seed)
    rows = []
    for mid in range(n):
        k = rnd.randint(1, 4)
        rows.append((mid, "|".join(rnd.choice(WORDS) for _ in range(k))))
    rows += [(n, ""), (n + 1, "|"), (n + 2, "   "), (n + 3, None), (n + 4, "a||b"), (n + 5, "Drama|")]
    return rows


def as_df(spark, rows):
    return spark.createDataFrame(rows, "mid int, genres string")


@pytest.mark.parametrize("genres", ["", "|", "a||b", "Drama|", "|Drama", " A  b ", "X|Y Z"])
def test_tokenizer_matches_jvm_split(spark, genres):
    df = as_df(spark, [(1, genres)])
    got = [r.token for r in content.genre_tokens(df).orderBy("pos").collect()]
    assert got == brute.tokens(genres)


@pytest.mark.parametrize("seed", [1, 2])
def test_pruned_pairs_equal_brute_force_exact_terms(spark, seed):
    rows = random_movies(seed)
    got = {(r.mid, r.other_mid): r.score
           for r in content.content_sim_pairs(as_df(spark, rows), term_space="exact").collect()}
    want = brute.cosine_pairs(rows)
    assert set(got) == set(want)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_pruned_pairs_equal_brute_force_hashed(spark):
    movies = fixtures.load_inputs(spark, SF_SMALL).movies
    toks = content.genre_tokens(movies).select("token").distinct()
    bucket = {r.token: r.b for r in toks.select("token", F.pmod(F.hash("token"), F.lit(50)).alias("b")).collect()}
    rows = [(r.mid, r.genres) for r in movies.select("mid", "genres").collect()]
    want = brute.cosine_pairs(rows, term=lambda t: bucket[t])
    got = {(r.mid, r.other_mid): r.score for r in content.content_sim_pairs(movies).collect()}
    assert set(got) == set(want)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_similarity_properties(spark):
    pairs = content.content_sim_pairs(as_df(spark, random_movies(3)), term_space="exact").collect()
    s = {(r.mid, r.other_mid): r.score for r in pairs}
    assert s, "fixture should produce pairs"
    assert all(0.6 < v <= 1.0 + 1e-12 for v in s.values())
    assert all((b, a) in s and abs(s[(b, a)] - v) < 1e-12 for (a, b), v in s.items())
    assert all(a != b for a, b in s)


def test_recs_k_is_exact_prefix_of_full_lists(spark):
    model = content.content_model(as_df(spark, random_movies(4)), term_space="exact")
    full = {r.mid: [(x.mid, x.score) for x in r.recs] for r in model.recs().collect()}
    for k in (1, 3, 7):
        cut = {r.mid: [(x.mid, x.score) for x in r.recs] for r in model.recs(k).collect()}
        assert cut == {m: lst[:k] for m, lst in full.items()}
    model.unpersist()


def test_recs_sorted_score_desc_then_mid(spark):
    recs = content.content_movie_recs(as_df(spark, random_movies(5)), term_space="exact").collect()
    for r in recs:
        keys = [(-x.score, x.mid) for x in r.recs]
        assert keys == sorted(keys)


def test_idf_and_tf(spark):
    df = as_df(spark, [(1, "a|b|a"), (2, "b"), (3, "c")])
    tf = {(r.mid, r.term): r.tf for r in content.hashed_tf(df, term_space="exact").collect()}
    assert tf[(1, "a")] == 2.0 and tf[(1, "b")] == 1.0
    idf = {r.term: (r.df, r.idf) for r in content.idf_weights(df, term_space="exact").collect()}
    import math
    assert idf["b"] == (2, pytest.approx(math.log(4 / 3)))


def test_salted_term_join_is_exact_on_a_hot_term(spark, monkeypatch):
    # every movie shares 'common'; tiny buckets force many salt buckets per term
    monkeypatch.setattr(content, "SALT_ROWS", 2)
    rnd = random.Random(7)
    rows = [(m, "common|" + "|".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 3)))) for m in range(80)]
    rows += [(100 + m, "solo%d" % m) for m in range(5)]
    got = {(r.mid, r.other_mid): r.score
           for r in content.content_sim_pairs(as_df(spark, rows), threshold=0.3, term_space="exact").collect()}
    want = brute.cosine_pairs(rows, threshold=0.3)
    assert set(got) == set(want)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_term_counts_run_lengths(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", "c", "b"]), (2, ["x"]), (3, [])], "id int, t array<string>")
    got = {r.id: (None if r.c is None else [(x.term, x.tf) for x in r.c])
           for r in df.select("id", content.term_counts(F.col("t")).alias("c")).collect()}
    assert got == {1: [("a", 1.0), ("b", 3.0), ("c", 1.0)], 2: [("x", 1.0)], 3: None}


def test_tokenizer_on_random_strings(spark):
    rnd = random.Random(11)
    alphabet = ["a", "B", "c", "|", " ", "\t", "\n", "\f", "#"]
    rows = [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12)))) for i in range(300)]
    got = {}
    for r in content.genre_tokens(as_df(spark, rows)).collect():
        got.setdefault(r.mid, []).append((r.pos, r.token))
    for mid, g in rows:
        assert [t for _, t in sorted(got.get(mid, []))] == brute.tokens(g), repr(g)


def test_zero_norm_vectors_have_no_pairs(spark):
    # 'drama' is in every movie: idf 0, so movies 1-3 have zero-norm vectors
    rows = [(1, "Drama"), (2, "Drama|Drama"), (3, "drama"), (4, "Drama|War"), (5, "War|Drama")]
    got = {(r.mid, r.other_mid) for r in content.content_sim_pairs(as_df(spark, rows), term_space="exact").collect()}
    assert got == {(4, 5), (5, 4)}
    assert got == set(brute.cosine_pairs(rows))


def test_similarity_entries_explodes_only_requested_lists(spark):
    recs = spark.createDataFrame([(1, [(2, 0.9), (3, 0.7)]), (2, [(1, 0.9)]), (3, [(1, 0.7)])],
                                 "mid int, recs array<struct<mid:int,score:double>>")
    want = spark.createDataFrame([(1,), (1,), (3,)], "mid int")
    got = sorted(map(tuple, content.similarity_entries(recs, want).collect()))
    assert got == [(1, 2, 0.9, 1), (1, 3, 0.7, 2), (3, 1, 0.7, 1)]


def test_bounds_end_most_candidates_and_lose_no_pair(spark):
    """Every pair above the threshold survives the residual-norm bound; the candidates that end early are the majority."""
    for space in ("hash", "exact"):
        model = content.content_model(fixtures.load_inputs(spark, SF_SMALL).movies, term_space=space)
        found = lambda df: {tuple(r) for r in df.select("ca", "cb").collect()}
        candidates, survivors = found(model.candidate_pairs()), found(model.surviving_pairs())
        verified = {p for p in found(model.class_pairs()) if p[0] < p[1]}
        assert verified <= survivors <= candidates
        assert model.candidate_pairs().count() == len(candidates)
        assert len(survivors) < 0.8 * len(candidates), space
        model.unpersist()
