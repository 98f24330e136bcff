import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import words
from tributary.llm import packing
from tributary.llm.tokens import UnitTokenizer
from tributary.llm.words import text_blocks

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER = UnitTokenizer(PATH)
ALPHABET = "aZé'ßÀ1½²×÷İ \t\n.,!<|>…́ 日👍σΣKſĳŉ \x1c "


def plain(texts):
    return [e.ids for e in ENCODER.tokenizer.encode_batch(texts, add_special_tokens=False)]


def in_bulk(texts, encoder=ENCODER, limit=1 << 20):
    out = []
    for _, block in text_blocks(pa.array(texts, pa.string()), limit):
        ids, starts = encoder.encode(block)
        assert all(ids[starts[1:] - 1] == 1)
        out += [ids[a:b - 1].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=30))
def test_ids_equal_those_of_the_tokenizer(texts):
    assert in_bulk(texts) == plain(texts)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_ids_of_any_characters(texts):
    assert in_bulk(texts) == plain(texts)


def test_small_memory_and_blocks_change_nothing():
    texts = [words(i, 30) for i in range(40)] + ["", "don't <|endoftext|> WE'LL"]
    assert in_bulk(texts, UnitTokenizer(PATH, most=50), limit=300) == plain(texts)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.integers(0, 64)), max_size=80))
def test_placing_keeps_all_limits(items):
    vectors = np.array([(a, 1, min(a, b)) for a, b in items], float).reshape(-1, 3)
    limits = np.array([64, 4, 40.0])
    vectors[:, 2] = np.minimum(vectors[:, 2], 40)
    bins = packing.place(vectors, limits)
    for b in np.unique(bins):
        assert (vectors[bins == b].sum(axis=0) <= limits).all()
    assert sorted(set(bins.tolist())) == list(range(bins.max(initial=-1) + 1))


def test_the_largest_dot_product_goes_first():
    vectors = np.array([[10, 1, 0], [30, 1, 30], [30, 1, 5], [64, 1, 0]], float)
    assert packing.place(vectors, np.array([64, 4, 40.0])).tolist() == [2, 0, 0, 1]
    with pytest.raises(ValueError):
        packing.place(np.array([[65.0, 1, 0]]), np.array([64, 4, 40.0]))


def test_every_id_lies_in_one_piece(odd_documents, no_documents):
    out = packing.pack_documents(odd_documents).toPandas()
    texts = odd_documents.select("doc_id", "text").toPandas()
    expected = []
    for i, text in zip(texts.doc_id, texts.text, strict=True):
        ids = np.array([*plain([text or ""])[0], 1], np.uint32)
        expected += [(str(i), a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].astype("<u4").tobytes()), len(ids))
                     for a in range(0, len(ids), 2048)]
    assert sorted((str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out.itertuples()) == sorted(expected)
    for _, part in out.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part.length.sum() <= 2048
        assert (part.offset == part.length.cumsum() - part.length).all()
    assert packing.pack_documents(no_documents).count() == 0


def test_padding_is_little(spark):
    draw = np.random.default_rng(0)
    lengths = np.minimum(2047, draw.lognormal(6, 1, 4000).astype(int) + 1).tolist()
    pieces = spark.createDataFrame([(i, 0, n, i, n) for i, n in enumerate(lengths)], packing._PIECES)
    out = packing.pack(pieces, group=1000).toPandas()
    assert out.length.sum() > 0.99 * 2048 * out.sequence_id.nunique()


def test_loss_tokens_are_limited(spark):
    pieces = spark.createDataFrame([(i, 0, 100, i, 100, 50 if i % 2 else None) for i in range(60)], packing._PIECES + ", loss_tokens long")
    out = packing.pack(pieces, limits=(1000, 100, 200)).toPandas()
    out["loss"] = np.where(out.doc_id % 2, 50, 100)
    assert out.groupby("sequence_id").loss.sum().max() <= 200
