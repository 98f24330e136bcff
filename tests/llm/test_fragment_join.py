import random

import numpy as np
import pytest

from tests.llm.conftest import words
from tests.llm.test_odd_sketches import near_copies, plain_components, plain_sets
from tributary.llm import fragment_join
from tributary.llm.components import components

SCHEMA = "doc_id long, text string"


def check(spark, texts, **options):
    ids = [i * 3 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), SCHEMA)
    out = fragment_join.similar_documents(docs, **options).toPandas().set_index("doc_id")
    sets = plain_sets(texts, options.get("words", 4))
    assert out.component_id.to_dict() == plain_components(ids, sets, options.get("percent", 85))
    assert out.n_shingles.to_dict() == {i: len(s) for i, s in zip(ids, sets, strict=True)}
    return out


def test_components_equal_brute_force(spark):
    texts = near_copies(1, 6, 40, 7) + [words(i, n) for i, n in enumerate([1, 2, 3, 4, 5, 30, 30])]
    out = check(spark, [*texts, "A b C", "a B c", "a b c d", "a b c e", None, "", words(8, 60), words(8, 60)])
    assert out.component_id.value_counts().iloc[0] > 5


@pytest.mark.parametrize(("percent", "fragments", "most"), [(60, 1, 0), (75, 20, 40)])
def test_other_shares_fragments_and_orders(spark, monkeypatch, percent, fragments, most):
    """The result does not depend on the order of n-grams, the fragments or the blocks."""
    monkeypatch.setattr(fragment_join, "BLOCK", 8)
    given = fragment_join.gram_order
    monkeypatch.setattr(fragment_join, "gram_order", lambda documents, size: given(documents, size, most))
    check(spark, near_copies(2, 4, 30, 14), percent=percent, fragments=fragments, words=3)


def test_chains_and_shared_passages(spark):
    """Links in a chain whose ends are far apart, and a passage that many otherwise different texts hold."""
    draw = random.Random(3)
    text, chain = words(1, 80).split(), []
    for i in range(25):
        text[3 * i] = words(1000 + i, 1)
        chain.append(" ".join(text))
    passage = words(2, 60)
    check(spark, chain + [f"{words(50 + i, draw.randint(5, 40))} {passage} {words(90 + i, draw.randint(5, 40))}" for i in range(40)])


def test_odd_rows(spark, odd_documents, no_documents):
    odd = odd_documents.withColumnsRenamed({"size": "n", "range": "gram", "label": "fragment", "stats": "s0"})
    out = fragment_join.similar_documents(odd).toPandas()
    known = out[out.doc_id.notna()].drop_duplicates().set_index("doc_id")
    assert known.component_id.to_dict() == {**{i: i for i in range(9)}, 7: 6, 9: 8}
    assert known.n_shingles.loc[[0, 1, 2, 3]].tolist() == [0, 0, 0, 1]
    assert len(out) == odd_documents.count() and out[out.doc_id.isna()].component_id.isna().all()
    assert fragment_join.similar_documents(no_documents).count() == 0


def test_one_id_with_different_texts(spark):
    a, b = words(1, 50), words(2, 50)
    docs = spark.createDataFrame([(7, a), (7, b), (3, a), (9, b), (11, b + " end"), (7, a)], SCHEMA)
    out = sorted(map(tuple, fragment_join.similar_documents(docs).select("doc_id", "component_id").collect()))
    assert out == [(3, 3), (7, 3), (7, 3), (7, 7), (9, 7), (11, 7)]


def test_first_grams_are_shared_by_similar_sets():
    """Any two sets that reach the share have a common one among the first of both, in any order."""
    draw = np.random.default_rng(1)
    for _ in range(400):
        n, percent = int(draw.integers(1, 60)), int(draw.integers(50, 101))
        a = draw.choice(200, n, replace=False)
        b = np.unique(np.where(draw.random(n) < 0.2, draw.integers(0, 200, n), a))
        common = len(np.intersect1d(a, b))
        if common * 100 >= percent * (len(a) + len(b) - common):
            rank = draw.permutation(200)
            first = [set(sorted(s, key=lambda x: rank[x])[:fragment_join.prefix_length(len(s), percent)]) for s in (a.tolist(), b.tolist())]
            assert first[0] & first[1]


def test_parities_differ_in_no_more_bits_than_sets():
    draw = np.random.default_rng(2)
    for n, m in [(600, 600), (1024, 1025), (700, 4500), (2000, 2000), (9000, 8000)]:
        a = draw.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[:int(draw.integers(0, min(n, m)))], draw.integers(0, 1 << 63, m).astype(np.uint64)])[:m]
        apart = len(np.setxor1d(a, b))
        for x, y in ((a, b), (b, a)):
            assert fragment_join.differing_parities(*map(fragment_join.parities, map(np.unique, (x, y)))) <= apart
        assert fragment_join.differing_parities(*[fragment_join.parities(np.unique(a))] * 2) == 0
    assert fragment_join.parities(a[:fragment_join.LONG]) is None and fragment_join.differing_parities(None, b"") == 0


def test_long_sets_that_are_not_similar_are_not_moved(spark, monkeypatch):
    """Long texts that share passages meet, but only those of a likely pair have their sets cut and moved."""
    moved, given = [], fragment_join.segments

    def segments(documents, classes, *rest):
        moved.extend(r.doc_id for r in classes.collect())
        return given(documents, classes, *rest)

    order = fragment_join.gram_order
    monkeypatch.setattr(fragment_join, "segments", segments)
    monkeypatch.setattr(fragment_join, "gram_order", lambda documents, size: order(documents, size, 0))  # common n-grams are not last
    passage = words(500, 400)
    texts = [f"{words(i, 4500)} {passage}" for i in range(6)]
    copy = texts[0].split()
    copy[::60] = ["changed"] * len(copy[::60])
    out = check(spark, [*texts, " ".join(copy), words(99, 30)])
    assert out.component_id.loc[18] == 0 and set(moved) == {0, 18}


def test_pivots_cut_the_order_evenly():
    cuts = fragment_join.pivots({20: 300, 40: 100}, 1000, 10)
    level = (cuts >> np.uint64(56)).tolist()
    assert len(cuts) == 9 and sorted(cuts.tolist()) == cuts.tolist() and level == [0, 0, 0, 0, 0, 20, 20, 20, 40]
    assert fragment_join.pivots({}, 0, 4).tolist() == sorted(fragment_join.pivots({}, 0, 4).tolist())


def test_components_take_up_stars(spark):
    found = components(spark.createDataFrame([(1, 2), (3, 4)], "a long, b long"))
    more = found.selectExpr("node AS a", "component AS b").union(spark.createDataFrame([(2, 4)], "a long, b long"))
    assert {r.node: r.component for r in components(more).collect()} == {1: 1, 2: 1, 3: 1, 4: 1}
