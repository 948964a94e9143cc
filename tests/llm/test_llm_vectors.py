"""Centroids, packing and hard negatives: against plain Python over whole small tables, and on awkward rows."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelrank.llm import centroids, negatives, packing, queries
from tests.conftest import SF_SMALL

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, cluster string, x int, row int, n string"


def embeddings(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", 1, 2, "z") for i, v, lab in rows], VECTORS)


def awkward(dims):
    """Vectors of ``dims`` components: ties, copies, nulls, not finite, wrong lengths, no ids or labels."""
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.26, 1.0]) for _ in range(dims)], rng.randrange(3)) for i in range(240)]
    same = rows[7][1]
    rows += [(i, same, 1) for i in range(240, 400)] + [(300, same, 2)] * 3
    rows += [(None, rows[3][1], 0), (None, rows[4][1], None), (401, None, 1), (402, [None] + same[1:], 1), (403, [NAN] + same[1:], 1),
             (404, [INF] + same[1:], 1), (405, same[1:], 1), (406, same + [0.5], 1), (500, same[1:], 2), (500, [], 1), (-100, same, 2),
             (407, same, None), (600, [x * 3 for x in same], 0)]
    return rows


# ------------------------------------------------------------------ centroids

def lloyd(rows, k=16, rounds=3, dims=64):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cs = [v for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for j in range(len(cs)):
            own = [v for (_, v), c in zip(kept, of) if c == j]
            if own:
                cs[j] = [sum(col) // len(own) for col in zip(*own)]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    per = defaultdict(int)
    for _, c, d in last:
        per[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return [(i, c, d, per[c], sum(per.values()), digest[c]) for i, c, d in last]


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_centroid_query(spark):
    want = lloyd(embeddings(spark))
    assert as_rows(queries.op11_centroids(spark, SF_SMALL)) == sorted(want, key=repr)


@pytest.mark.parametrize("width", [3, 7])
def test_centroids_awkward(spark, width):
    rows = awkward(7)
    got = centroids.cluster(table(spark, rows), k=5, dims=7, width=width)
    assert as_rows(got) == sorted(lloyd(rows, k=5, dims=7), key=repr)


def test_centroids_few_and_none(spark):
    few = [(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0), (None, [1.0, 0.0], 0)]
    got = as_rows(centroids.cluster(table(spark, few), k=16, dims=2))
    assert got == sorted(lloyd(few, k=16, dims=2), key=repr) and len(got) == 3
    empty = centroids.cluster(table(spark, few).limit(0), dims=2)
    assert empty.count() == 0
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroids.cluster(table(spark, [(None, [1.0, 0.0], 0)]), dims=2).count() == 0  # nothing can start a centroid
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(table(spark, [(1, [1e30, 0.0], 0)]), dims=2).count()


def test_partial_distances_are_exact():
    rng = np.random.default_rng(3)
    for top in (100, centroids.LARGEST):
        x, c = rng.integers(-top, top, (50, 16)), rng.integers(-top, top, (5, 16))
        want = [[sum((a - b) ** 2 for a, b in zip(r, s)) for s in c.tolist()] for r in x.tolist()]
        assert centroids.partial_distances(x, c).tolist() == want


# ------------------------------------------------------------------ hard negatives

def mined(rows, every=100, pos=5, neg=5, relabel=True):
    kept = []
    for n, (i, v, lab) in enumerate(rows):
        if lab is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        if relabel and i is not None and i % 7 == 0:
            lab = (lab + 1) % 10
        kept.append((n, i, [math.floor(256 * x) for x in v], lab))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for n, i, v, lab in kept:
        if i is None or i % every:
            continue
        other = [(dot(v, w), j, m, lb) for m, j, w, lb in kept if m != n and len(w) == len(v)]
        for ps, p, _, _ in sorted((r for r in other if r[3] == lab), key=order)[:pos]:
            fits = sorted((r for r in other if r[3] != lab and 80 * ps <= 100 * r[0] <= 100 * ps), key=order)[:neg]
            out += [(i, p, k, r[1], ps, r[0]) for k, r in enumerate(fits, 1)]
    return sorted(out, key=repr)


def test_negative_query(spark):
    got = as_rows(queries.op13_hard_negatives(spark, SF_SMALL))
    assert got == mined(embeddings(spark)) and len(got) > 50


@pytest.mark.parametrize("dims", [5, 12])
def test_negatives_awkward(spark, dims, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 400)  # several blocks of anchors
    rows = awkward(dims)
    got = as_rows(negatives.mine(table(spark, rows), every=20))
    assert got == mined(rows, every=20, relabel=False) and len(got) > 100
    assert negatives.mine(table(spark, rows).limit(0)).count() == 0
    assert negatives.mine(table(spark, [(1, [0.5], 1)])).count() == 0  # no anchor


def test_tree_prunes_and_loses_nothing():
    """On clustered rows most leaves stay closed; the rows found are those of a full scan."""
    rng = np.random.default_rng(2)
    centre = rng.integers(-200, 200, (40, 8))
    x = np.repeat(centre, 200, axis=0) + rng.integers(-6, 7, (8000, 8))
    order, starts = negatives.str_order(x, list(range(8))[:3], 64)
    assert sorted(order.tolist()) == list(range(8000)) and np.diff(starts).max() <= 64
    ids = rng.permutation(8000)
    tree = negatives.Tree(x[order].astype(float), ids, np.zeros(8000, bool), np.zeros(8000, np.int64), ids, starts)
    q = x[rng.integers(0, 8000, 20)].astype(float)
    low, high = tree.bounds(q)
    opened = 0
    for j in range(len(q)):
        scores = tree.x @ q[j]
        assert (low[j, -1] <= scores).all() and (scores <= high[j, -1]).all()
        mid = int(np.sort(scores)[-500])
        for lo, hi in ((-(1 << 63), (1 << 63) - 1), (mid - 500, mid)):
            best = negatives.Best(5, lo, hi)
            opened += negatives.search(tree, q[j], low[j], high[j], [best], lambda at: np.ones(len(at), bool))
            want = sorted((-int(s), False, int(i), int(i)) for s, i in zip(scores, ids) if lo <= s <= hi)[:5]
            assert best.found == want
    assert opened < 0.5 * 40 * (len(starts) - 1)


# ------------------------------------------------------------------ packing

TEXTS = [
    None, "", " \n\t ", "Hello, World!", "It's we'll THEY'RE 42 x2y ##$$ a_b", "ÀÉÎ straße İstanbul naïve", "éä ẞ İ",
    "a\x1cb\x85c\xa0d e", "漢字 かな 한국어 привет Σίσυφος ΣΑΣ", "<|endoftext|> a<|startoftext|>b <|endoftext", "²³¼ ½x ٣٤", "\U0001f600‍\U0001f525 ok",
    "word " * 5000, "q" * 3000, "don't 'S 'LL ''s",
]


def tokens(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(queries.word_bpe())
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def check_packing(spark, docs, got, length=2048):
    """Every id of every document in exactly one piece, sequences full or of a power of two, offsets without gaps."""
    rows = sorted((r for r in got.collect()), key=lambda r: (r.sequence_id, r.offset))
    at = defaultdict(int)
    for r in rows:
        assert r.offset == at[r.sequence_id] and 0 < r.length <= length
        at[r.sequence_id] += r.length
    assert sorted(at) == list(range(len(at)))
    sizes = [at[i] for i in range(len(at))]
    full = sum(sizes) // length
    assert sizes[:full] == [length] * full and all(s & (s - 1) == 0 for s in sizes[full:])
    want = defaultdict(list)  # documents by id: repeated ids are told apart by their pieces' sums
    for (i, _), ids in zip(docs, tokens([t for _, t in docs])):
        want[i].append(np.array(ids, dtype="<u4"))
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert pieces.keys() == want.keys()
    for i, own in want.items():
        assert sum(r.length for r in pieces[i]) == sum(map(len, own))
        fits = {(s, n, zlib.crc32(ids[s:s + n].tobytes()), len(ids)) for ids in own for r in pieces[i]
                for s, n in [(r.start, r.length)] if s + n <= len(ids)}
        assert all((r.start, r.length, r.ids_crc32, r.doc_tokens) in fits for r in pieces[i])
        assert sum(r.start == 0 for r in pieces[i]) == len(own)
    return sizes


def test_packing_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check_packing(spark, docs, queries.op12_hilbert_packing(spark, SF_SMALL))


def test_packing_awkward(spark):
    docs = [(i if i % 5 else None, t) for i, t in enumerate(TEXTS)] + [(3, "Hello, World!")] * 4
    df = spark.createDataFrame([(*d, 1, 2, "k") for d in docs], "doc_id long, text string, n int, `key` int, ids string")
    packed = packing.pack(df, queries.word_bpe(), length=64).withColumn("ids_crc32", F.crc32("ids"))
    sizes = check_packing(spark, docs, packed, 64)
    whole = {r.sequence_id: (r.n, bytes(r.ids)) for r in packing.sequences(packed).collect()}
    assert [whole[i][0] for i in range(len(sizes))] == sizes and all(len(b) == 4 * n for n, b in whole.values())
    assert packing.pack(df.limit(0), queries.word_bpe()).count() == 0


def test_words_equal_the_library():
    """Random words over letters, marks, signs and spaces: the ids of the library on the whole text."""
    rng = random.Random(9)
    letters = "abcXYZ'stredvml0123 \n\t\r-_.,#$%&<|>" + "éßÖİıÇ²½ªº×÷" + "\xa0\x85\x1c" + "́̈Σςжя漢ﬁÅΩ٣"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)] + TEXTS[1:]
    words = packing.Words(queries.word_bpe())
    assert words.cut is not None
    got = [[*i.tolist(), 1] for i in words(pa.array(texts, pa.string()))]
    assert got == tokens(texts)


def test_words_start_again(monkeypatch):
    monkeypatch.setattr(packing, "MAX_KNOWN", 50)
    words = packing.Words(queries.word_bpe())
    for a in range(0, 400, 40):
        texts = [f"w{i} common x{i * i}" for i in range(a, a + 40)]
        assert [[*i.tolist(), 1] for i in words(pa.array(texts, pa.string()))] == tokens(texts)


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_steps(axes, bits):
    """The curve visits every cell once and moves by one cell along one axis."""
    cells = np.array(np.meshgrid(*[range(1 << bits)] * axes)).reshape(axes, -1).T
    keys = packing.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(1 << bits * axes))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_share_sequences(spark):
    """Documents of one topic lie closer along the curve than in the order of ids."""
    topics = ["river boat water fish stream", "engine wheel motor brake clutch", "violin chord melody sonata tempo"]
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(topics[i % 3].split()) for _ in range(60))) for i in range(300)]
    packed = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), queries.word_bpe(), length=256)
    order = [r.doc_id for r in packed.where("start = 0").orderBy("sequence_id", "offset").collect()]
    changes = sum(a % 3 != b % 3 for a, b in zip(order, order[1:]))
    assert changes < 100  # of 299 in the order of ids


def test_tail_cuts():
    for total in (0, 1, 63, 64, 65, 127, 1000):
        cuts = packing.tail_cuts(total, 64)
        assert cuts[0] == total // 64 * 64 and cuts[-1] == total
        assert all((b - a) & (b - a - 1) == 0 and b > a for a, b in zip(cuts, cuts[1:]))
