import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import dynamic_itemsets
from tributary.llm.key_filter import MOST_BITS, KeyFilter, key_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain_collocations(rows, threshold=10, longest=3, top=2000, absorbed=50):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for length in range(1, longest + 1):
                for i in range(len(words) - length + 1):
                    counts[lang, tuple(words[i:i + length])] += 1
    found, longer = [], Counter()
    for (lang, phrase), a in counts.items():
        if len(phrase) < 2 or a < threshold:
            continue
        for begin in range(len(phrase)):
            for end in range(begin + 2, len(phrase) + 1):
                if end - begin < len(phrase):
                    longer[lang, phrase[begin:end]] = max(longer[lang, phrase[begin:end]], a)
        score, _, left, right = min(
            (1_000_000 * a * a // (counts[lang, phrase[:k]] * counts[lang, phrase[k:]]), k, counts[lang, phrase[:k]], counts[lang, phrase[k:]])
            for k in range(1, len(phrase)))
        found.append((lang, phrase, a, left, right, score))
    out = []
    for own in {f[0] for f in found}:
        kept = sorted(((-s, -a, " ".join(p).encode(), left, right) for lang, p, a, left, right, s in found
                       if lang == own and 100 * longer[lang, p] < absorbed * a))
        out += [(own, rank, p.decode(), -a, left, right, totals[own], -s) for rank, (s, a, p, left, right) in enumerate(kept[:top], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def sentences(seed, n):
    draw = random.Random(seed)
    stock = ["New York City", "ab cd ef gh", "x y", "É ü", "the the the the", "one Two three"]
    rows = []
    for _ in range(n):
        parts = [draw.choice(stock) if draw.random() < 0.6 else "".join(draw.choice("abc") for _ in range(draw.randint(1, 3))) for _ in range(draw.randint(0, 14))]
        text = "".join(p + draw.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", " "]) for p in parts)
        rows.append((draw.choice(["en", "en", "de", None, "und", ""]), text))
    return rows


@pytest.mark.parametrize(("shards", "longest", "top"), [(1, 3, 5), (3, 4, 2000)])
def test_equals_brute_force(spark, shards, longest, top):
    rows = sentences(shards, 300)
    documents = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    out = dynamic_itemsets.collocations(documents, longest=longest, top=top, shards=shards)
    assert found(out) == plain_collocations(rows, longest=longest, top=top)


def test_late_phrases_are_counted_over_a_whole_cycle(spark):
    """Phrases whose words reach the threshold only in the last shard of the first cycle."""
    rows = [("en", f"rare words stand together {i}") for i in range(12)] + [("en", "rare words")] * 7
    documents = spark.createDataFrame(rows, "lang string, text string")
    for threshold in (12, 20):
        out = dynamic_itemsets.collocations(documents, threshold=threshold)
        assert found(out) == plain_collocations(rows, threshold=threshold)


def test_full_filters_change_nothing(spark, monkeypatch):
    """Filters that let nearly all pass give the same result."""
    monkeypatch.setattr("tributary.llm.key_filter.MOST_BITS", 64)
    rows = sentences(9, 150)
    out = dynamic_itemsets.collocations(spark.createDataFrame(rows, "lang string, text string"), threshold=4, shards=3)
    assert found(out) == plain_collocations(rows, threshold=4)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(r.lang, r.text) for r in odd_documents.collect()]
    odd = odd_documents.withColumnsRenamed({"rank": "score", "key": "phrase", "size": "tag"})
    assert found(dynamic_itemsets.collocations(odd, threshold=2)) == plain_collocations(rows, threshold=2)
    assert dynamic_itemsets.collocations(no_documents).count() == 0
    with pytest.raises(ValueError, match="words"):
        dynamic_itemsets.collocations(no_documents, longest=8)


def test_scores_pass_64_bits(spark):
    a, left, right = 3_000_000_000_000, 9_000_000_000_000, 9_007_199_254_740_993
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(dynamic_itemsets.exact_score("a", "l", "r").alias("s")).first()
    assert row.s == 1_000_000 * a * a // (left * right)


def test_keys_give_back_their_last_word():
    draw = np.random.default_rng(1)
    words = dynamic_itemsets._keys(draw.integers(0, 2**63, 1000, dtype=np.uint64), 1)
    first = dynamic_itemsets.extended(words[::-1].copy(), words, 2)
    assert (dynamic_itemsets.last_word(first, words[::-1].copy()) == words).all()
    longer = dynamic_itemsets.extended(first, words, 3)
    assert (dynamic_itemsets.last_word(longer, first) == words).all() and set((longer & np.uint64(7)).tolist()) == {3}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-2**63, 2**63 - 1), max_size=50))
def test_filter_holds_what_was_put_in(spark, keys):
    built = key_filter(spark.createDataFrame([(k,) for k in keys] + [(None,)], "key long"))
    assert isinstance(built, KeyFilter) and MOST_BITS >= 64
    assert built.holds(np.array(keys, np.int64)).all()
    others = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 20000)
    assert built.holds(others).mean() < (0.05 if keys else 1e-9)
