import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.llm.conftest import words
from tributary.llm import latent_search

ITEMS = [words(9000 + i, 14 + 3 * i) for i in range(20)]


def test_exact_and_changed_passages_are_found_and_clean_ones_left(spark):
    draw = random.Random(4)
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(ITEMS)], "item_id long, text string")
    docs, expected = [], set()
    for i in range(200):
        text = words(i, draw.randint(5, 400)).split()
        if i % 4 == 0:
            item = i // 4 % len(ITEMS)
            passage = ITEMS[item].upper().split() if i % 8 else ITEMS[item].split()
            if i % 12 == 0:  # a paraphrase: every sixth word is another one
                passage = [words(i + k, 1) if k % 6 == 2 else w for k, w in enumerate(passage)]
            at = draw.randint(0, len(text))
            text[at:at] = passage
            expected.add((i, item))
        docs.append((i, ("\n" if i % 2 else " ").join(text)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = latent_search.find_leaks(table, benchmark).toPandas()
    assert set(zip(found.doc_id, found.item_id, strict=True)) == expected
    kept = {r.doc_id for r in latent_search.remove_leaks(table, benchmark).collect()}
    assert kept == set(range(200)) - {i for i, _ in expected}


def test_replaced_rare_words_hide_no_item(spark):
    """The rarest fifth of the words, or the rarest 35 % before the answer, are other ones; the rest stands in order."""
    common = sorted(set(words(77, 60).split()))
    items, docs, expected = [], [(1000 + i, " ".join(random.Random(i).choices(common, k=300))) for i in range(150)], set()
    for i in range(12):
        draw, n = random.Random(500 + i), 34 + 2 * i
        rare = {k: f"rare{i}x{k}" for k in draw.sample(range(n * 3 // 4), n // 3)}
        item = [rare.get(k) or draw.choice(common) for k in range(n)]
        items.append((i, " ".join(item)))
        for kind, lost in enumerate((n // 5, n // 3)):
            gone = set(sorted(rare)[:lost])
            passage = [f"new{i}x{k}" if k in gone else w for k, w in enumerate(item)]
            docs.append((2 * i + kind, " ".join(draw.choices(common, k=90) + passage + draw.choices(common, k=70))))
            expected.add((2 * i + kind, i))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = latent_search.find_leaks(table, spark.createDataFrame(items, "item_id long, text string")).toPandas()
    assert expected <= set(zip(found.doc_id, found.item_id, strict=True))


@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=20), min_size=1, max_size=4), st.lists(st.integers(0, 9), min_size=1, max_size=150),
       st.lists(st.integers(0, 50), min_size=10, max_size=10))
def test_the_screen_refuses_no_passage_that_could_be_confirmed(items, text, frequency):
    vocabulary = np.arange(10, dtype=np.uint64)
    items, text = [np.array(i, np.uint64) for i in items], np.array(text, np.uint64)
    screen = latent_search._screen(items, vocabulary, np.array(frequency))
    assert (screen.needed > 0).all()
    block = latent_search.Block(64, [], items, [], vocabulary, None, None, screen)
    place = np.flatnonzero(np.isin(text, screen.terms))
    pairs = {(k, i) for keys, own in latent_search._screened(block, np.zeros(len(place), np.int64), place, np.searchsorted(screen.terms, text[place]))
             for k, i in zip(keys.tolist(), own.tolist(), strict=True)}
    for index in range(len(text) // 32 + 1):
        begin = max(0, index * 32 - 16)
        for i, item in enumerate(items):
            if latent_search.common_subsequence(item, text[begin:begin + 96]) / len(item) >= latent_search.LCS_LIKELY:
                assert (index, i) in pairs


def test_the_answer_decides_where_the_order_does_not(spark):
    item = words(1, 30).split()
    likely = item[:15] + [words(50 + k, 1) for k in range(8)] + item[23:]  # 22 of 30 words, with the answer
    without = item[:22] + [words(70 + k, 1) for k in range(8)]  # 22 of 30 words, without it
    docs = spark.createDataFrame([(1, " ".join(likely)), (2, " ".join(without))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert [r.doc_id for r in latent_search.find_leaks(docs, benchmark).collect()] == [1]
    given_answer = spark.createDataFrame([(7, " ".join(item), " ".join(item[16:18]))], "item_id long, text string, answer string")
    assert [r.doc_id for r in latent_search.find_leaks(docs, given_answer).collect()] == [2]


@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.lists(st.integers(0, 4), max_size=30))
def test_common_subsequence(item, passage):
    rows = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item):
        for j, b in enumerate(passage):
            rows[i + 1][j + 1] = rows[i][j] + 1 if a == b else max(rows[i][j + 1], rows[i + 1][j])
    assert latent_search.common_subsequence(np.array(item, np.uint64), np.array(passage, np.uint64)) == rows[-1][-1]


def test_the_basis_is_that_of_a_plain_decomposition(spark):
    """Distributed products give the leading singular directions of the whole matrix."""
    docs = spark.createDataFrame([(i, " ".join([ITEMS[i % 5], words(i, 40)])) for i in range(60)], "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(ITEMS[:5])], "item_id long, text string").toPandas()
    blocks = latent_search.build_blocks(benchmark, docs)
    latent_search.fit_latent(docs, blocks)
    passages = latent_search._passages(docs, blocks).toPandas()
    for number, block in enumerate(blocks):
        own = passages[passages.block == number]
        matrix = np.zeros((len(own), len(block.terms)))
        for row, (terms, weights) in enumerate(zip(own.terms, own.weights, strict=True)):
            matrix[row, np.frombuffer(terms, np.int32)] = np.frombuffer(weights, np.float32)
        items = block.vectors * np.sqrt(max(1.0, len(own) / len(block.ids)))
        _, _, right = np.linalg.svd(np.vstack([matrix, items]), full_matrices=False)
        lead = right[:len(block.ids)]
        assert np.linalg.norm(lead @ block.basis, axis=1) == pytest.approx(np.ones(len(lead)), abs=1e-3)


def test_odd_rows(spark, odd_documents, no_documents):
    benchmark = spark.createDataFrame([(1, None), (2, ""), (None, words(2, 50)), (4, "one"), (4, "one"), (5, ITEMS[0])], "item_id long, text string")
    found = latent_search.find_leaks(odd_documents, benchmark).toPandas()
    assert sorted(zip(found.doc_id.astype(int), found.item_id.fillna(-1).astype(int), strict=True)) == [(3, 4), (3, 4)] + [(8, -1)] * 3 + [(9, -1)]
    kept = latent_search.remove_leaks(odd_documents, benchmark)
    assert kept.schema == odd_documents.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [0, 1, 2, 4, 5, 6, 7, None, None]))
    assert latent_search.find_leaks(no_documents, benchmark).count() == 0
    assert latent_search.find_leaks(odd_documents, benchmark.filter("false")).count() == 0
    assert latent_search.remove_leaks(odd_documents, benchmark.filter("false")).count() == odd_documents.count()
