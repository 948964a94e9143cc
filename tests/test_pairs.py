"""What all pairs of movies carry: numbers of classes, large chunks, scores rounded once a class."""

import pytest
from pyspark.sql import functions as F

from reelrank.operators import content


def movies(spark):
    """Classes of up to 200 movies, ids twice and null, a null and an empty genre string."""
    rows = [(m, ["a|b", "a|b|c", "d|e", "a|b|c|f", "g|a|h"][m % 7 % 5]) for m in range(700)]
    rows += [(8, "a|b"), (9, "d|e"), (None, "a|b"), (900, None), (901, ""), (902, "||")]
    return spark.createDataFrame(rows, "mid int, genres string")


@pytest.mark.parametrize("space", ["hash", "exact"])
def test_chunks_and_numbers_change_no_pair(spark, monkeypatch, space):
    small = content.content_model(movies(spark), 0.3, term_space=space, keep=False)
    monkeypatch.setattr(content, "CHUNKS", 4)
    large = content.content_model(movies(spark), 0.3, term_space=space, keep=False)
    assert small.chunk == content.CHUNK and large.chunk == 706 // 4
    for model in (small, large):  # no text goes with a pair of classes
        assert {dict(x.dtypes)[c] for x, c in ((model.members, "ckey"), (model.vectors, "ckey"), (model.class_pairs(), "ca"))} == {"bigint"}
    a, b = (sorted(map(tuple, m.pairs().na.fill(-1).collect())) for m in (small, large))
    assert a == b and len(a) > 50_000
    of = {}
    for r in movies(spark).collect():
        of.setdefault(r.genres, []).append(r.mid)
    twins = {(x, y) for g in ("a|b", "d|e") for x in of[g] for y in of[g] if None not in (x, y) and x != y}
    assert twins <= {(x, y) for x, y, _ in a}
    lists = [sorted((-1 if r.mid is None else r.mid, r.rank, -1 if r.other_mid is None else r.other_mid, r.score)
                    for r in content.similarity_entries(m.lists()).collect()) for m in (small, large)]
    assert lists[0] == lists[1]


def test_scores_are_rounded_after_they_have_ordered_the_lists(spark):
    """Two digits make scores equal that order the entries; the order stays that of the whole scores."""
    rows = [(i, "x|" + "|".join(f"y{j}" for j in range(3 + (i * 5) % 9)) + f"|z{i % 4}") for i in range(60)]
    table = spark.createDataFrame(rows, "mid int, genres string")
    whole, cut = (content.similarity_entries(content.content_movie_recs(table, 0.3, term_space="exact", digits=d)) for d in (None, 2))
    want = sorted((r.mid, r.rank, r.other_mid, r.score) for r in whole.withColumn("score", F.round("score", 2)).collect())
    got = sorted((r.mid, r.rank, r.other_mid, r.score) for r in cut.collect())
    assert got == want
    by_cut = sorted(got, key=lambda x: (x[0], -x[3], x[2]))
    assert [x[2] for x in by_cut] != [x[2] for x in got]
    pairs = content.content_sim_pairs(table, 0.3, term_space="exact", digits=2)
    assert sorted(map(tuple, pairs.collect())) == sorted((m, o, s) for m, _, o, s in want)
    # rounded before the pairs are listed, so once for all movies of two classes
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(others") < plan.index("FLOOR")
