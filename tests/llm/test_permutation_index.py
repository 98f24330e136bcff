import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import permutation_index


def plain(ids, vectors, k=20):
    out = {}
    for i in {i for i in ids if i % 20 == 0}:
        query = vectors[ids.index(i)]
        scores = [((v * query).sum(), j) for j, v in zip(ids, vectors, strict=True) if j != i]
        out[i] = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
    return out


def search(spark, ids, vectors, **options):
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>")
    out = {}
    for r in permutation_index.nearest(table, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_and_exact_scores(spark, lengths):
    draw = np.random.default_rng(0)
    vectors = draw.standard_normal((4000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if lengths:
        vectors *= draw.uniform(0.5, 2, (4000, 1))
    vectors = vectors.astype(np.float32).astype(float)
    ids = list(range(4000))
    got, expected = search(spark, ids, vectors, block=1500), plain(ids, vectors)
    assert got.keys() == expected.keys()
    recall = [len({j for _, j in got[i]} & {j for _, j in expected[i]}) / 20 for i in expected]
    assert np.mean(recall) >= 0.9
    for i, found in got.items():
        assert all(score == (vectors[i] * vectors[j]).sum() for score, j in found)
        assert found == sorted(found, key=lambda s: (-s[0], s[1]))


def test_equal_vectors_go_by_id(spark):
    vectors = np.vstack([np.tile([1.0, 0.0, 0.0], (300, 1)), np.eye(3)[1:].repeat(20, axis=0)])
    ids = list(range(len(vectors)))
    assert search(spark, ids, vectors, block=100) == plain(ids, vectors)


def test_few_and_odd_vectors(spark):
    table = spark.createDataFrame(
        [(0, [1.0, 2.0], 1), (20, [2.0, 1.0], 1), (20, [2.0, 1.0], 1), (3, [float("nan"), 1.0], 1), (4, [None, 1.0], 1), (5, None, 1),
         (6, [0.0, 0.0], 1), (7, [float("inf"), 0.0], 1), (40, [], 1), (8, [1.0, 1.0, 1.0], 1), (None, [1.0, 1.0], 1), (9, [-1.0, 0.0], 1)],
        "vec_id long, embedding array<float>, score int")
    rows = permutation_index.nearest(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in rows] == [(0, 1, 20, 4.0), (0, 2, 9, -1.0), (20, 1, 0, 4.0), (20, 2, 9, -2.0)]
    assert permutation_index.nearest(table.filter("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert permutation_index.nearest(table, F.col("vec_id") == 3).count() == 0


def test_copies_neither_fill_the_reranked_share_nor_the_pivots(spark):
    """A third of the rows are one vector, near which all others rank the copies first."""
    draw = np.random.default_rng(3)
    centre = draw.standard_normal(32)
    vectors = draw.standard_normal((3000, 32)) + centre
    vectors[draw.permutation(3000)[:1000]] = centre + 0.3 * draw.standard_normal(32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors.astype(np.float32).astype(float)
    ids = list(range(3000))
    got, expected = search(spark, ids, vectors), plain(ids, vectors)
    assert got.keys() == expected.keys()
    recall = [np.mean([score >= expected[i][-1][0] for score, _ in got[i]]) for i in expected]
    assert np.mean(recall) >= 0.9


def test_an_id_with_several_vectors_counts_once(spark):
    draw = np.random.default_rng(4)
    vectors = draw.standard_normal((300, 8)).astype(np.float32).astype(float)
    ids = [i % 60 for i in range(300)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>")
    got = {}
    for r in permutation_index.nearest(table, F.col("vec_id") == 0, block=100).collect():
        got[r.vec_id] = r.score
    scores = {j: max((vectors[q] * vectors[i]).sum() for q in range(0, 300, 60) for i in range(j, 300, 60)) for j in range(1, 60)}
    best = sorted(scores, key=lambda j: (-scores[j], j))[:20]
    assert got == {j: scores[j] for j in best}


@pytest.mark.parametrize("prefix", [40, 300])
def test_block_reranks_the_nearest_orders(monkeypatch, prefix):
    """Sums of places agree with the footrule distances of whole orders, for short and long prefixes."""
    monkeypatch.setattr(permutation_index, "LEAST_RERANKED", 12)
    draw = np.random.default_rng(prefix)
    vectors = draw.standard_normal((90, 6))
    orders, pivots = np.array([draw.permutation(320)[:prefix] for _ in vectors], np.uint16), 320
    places = np.full((90, pivots), prefix)
    places[np.arange(90)[:, None], orders] = np.arange(prefix)
    found = permutation_index.search_block([np.array([i]) for i in range(90)], vectors, orders, pivots,
                                           np.arange(5), vectors[:5], orders[:5], 4)
    for query, ids, scores in found:
        distance = np.abs(places - places[query]).sum(axis=1)
        near = sorted(range(90), key=lambda i: (distance[i], i))[:13]
        best = sorted((-(vectors[i] * vectors[query]).sum(), i) for i in near if i != query)[:4]
        assert ids.tolist() == [i for _, i in best] and np.allclose(-scores, [s for s, _ in best])
