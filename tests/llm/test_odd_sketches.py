import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import words
from tributary.llm import odd_sketches
from tributary.llm.components import components
from tributary.llm.words import shingle_set, text_blocks, words_of


def plain_sets(texts, size):
    """Shingle sets as stated: words between ASCII white space, A-Z in lower case."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for text in texts:
        own = [w for w in (text or "").translate(lower).replace("\t", " ").replace("\n", " ").replace("\x0b", " ")
               .replace("\x0c", " ").replace("\r", " ").split(" ") if w]
        size_here = min(size, len(own))
        out.append({tuple(own[i:i + size_here]) for i in range(len(own) - size_here + 1)} if own else set())
    return out


def plain_components(ids, sets, percent):
    parent = {i: i for i in ids}
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in zip(ids, sets, strict=True):
        for j, b in zip(ids, sets, strict=True):
            if i < j and a and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in ids}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbÉé \t\n\x0b\x1c 日", max_size=25), min_size=1, max_size=10), st.integers(1, 5), st.sampled_from([1, 30, 1 << 20]))
def test_shingles_follow_the_words(texts, size, limit):
    found = []
    for _, block in text_blocks(pa.array([*texts, None]), limit):
        cut = words_of(block)
        found += [shingle_set(cut.hash[cut.starts[i]:cut.starts[i + 1]], size) for i in range(len(block))]
    expected = plain_sets([*texts, None], size)
    assert [len(s) for s in found] == [len(s) for s in expected]
    for a, x in zip(found, expected, strict=True):
        for b, y in zip(found, expected, strict=True):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_sketches_estimate_high_similarities():
    draw = np.random.default_rng(1)
    for similarity in (0.6, 0.8, 0.9, 0.95):
        n, bits = 400, []
        for _ in range(60):
            common = draw.integers(0, 2**63, int(n * similarity), dtype=np.uint64)
            own = [draw.integers(0, 2**63, int(n * (1 - similarity) / 2), dtype=np.uint64) for _ in range(2)]
            a, b = odd_sketches.odd_sketch(np.array([odd_sketches.min_hashes(np.append(common, o)) for o in own]))
            bits.append(int(np.bitwise_count(a ^ b).sum()))
        assert np.mean(bits) == pytest.approx(odd_sketches.most_differing_bits(similarity), rel=0.1, abs=4)


def near_copies(seed, groups, copies, edits):
    draw = random.Random(seed)
    texts = []
    for group in range(groups):
        base = words(100 + group, 90).split()
        for _ in range(copies):
            text = list(base)
            for _ in range(draw.randint(0, edits)):
                text[draw.randrange(len(text))] = words(draw.randrange(10**6), 1)
            texts.append(" ".join(text))
    draw.shuffle(texts)
    return texts


def test_components_equal_brute_force(spark):
    texts = near_copies(1, 6, 40, 8) + [words(i, n) for i, n in enumerate([1, 2, 3, 4, 5, 30, 30])] + ["A b C", "a B c", "a b c d", "a b c e", None, ""]
    docs = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = odd_sketches.near_duplicates(docs, words=4).toPandas().set_index("doc_id")
    ids = [i * 3 for i in range(len(texts))]
    sets = plain_sets(texts, 4)
    assert out.component_id.to_dict() == plain_components(ids, sets, 80)
    assert out.n_shingles.to_dict() == {i: len(s) for i, s in zip(ids, sets, strict=True)}
    assert (out.kept == (out.index == out.component_id)).all()
    kept = odd_sketches.keep_one_each(docs, words=4)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(out.index[out.kept])


def test_odd_rows(odd_documents, no_documents):
    out = odd_sketches.near_duplicates(odd_documents).toPandas()
    known = out[out.doc_id.notna()].drop_duplicates().set_index("doc_id")
    assert known.component_id.to_dict() == {**{i: i for i in range(9)}, 7: 6, 9: 8}
    assert known.n_shingles.loc[[0, 1, 2, 3]].tolist() == [0, 0, 0, 1]
    assert len(out) == odd_documents.count() and out[out.doc_id.isna()].component_id.isna().all() and out[out.doc_id.isna()].kept.all()
    kept = odd_sketches.keep_one_each(odd_documents)
    assert kept.schema == odd_documents.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [0, 1, 2, 3, 4, 5, 6, 8, None, None]))
    assert odd_sketches.near_duplicates(no_documents).count() == 0
    assert odd_sketches.keep_one_each(no_documents).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(40)],
                                   [(0, i) for i in range(1, 200)] + [(300, 199), (500, 501), (None, 3)]])
def test_components_of_edges(spark, edges):
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    proper = [(a, b) for a, b in edges if a is not None and a != b]
    parent = {n: n for e in proper for n in e}
    for _ in range(len(proper)):
        changed = False
        for a, b in proper:
            low = min(parent[a], parent[b])
            changed |= parent[a] != low or parent[b] != low
            parent[a] = parent[b] = low
        if not changed:
            break
    assert found == parent
