import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: Names that operators use inside, as further columns of an input.
CLASHING = ("id", "key", "size", "shard", "range", "label", "stats", "bands", "component", "block", "rank", "page_id", "spans", "kept", "row")


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(n))


@pytest.fixture
def odd_documents(spark):
    """Null, empty, blank, tiny, very long, repeated and odd texts, null ids, and columns with clashing names."""
    long_text = words(1, 60_000)
    texts = [None, "", "   \n\t", "one", "Two words", "ÄÖ ß é ½ 日本  x", long_text, long_text + " end", words(2, 50), words(2, 50)]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, words(3, 40), None, None, 7), (None, None, None, None, None)]
    return spark.createDataFrame([r + (1,) * len(CLASHING) for r in rows], ", ".join([DOCUMENTS, *(f"`{c}` int" for c in CLASHING)]))


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
