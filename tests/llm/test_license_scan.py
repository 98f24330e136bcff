import math
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import words
from tributary.llm import license_scan


def plain(text, notices, size=3, containment=0.8):
    """Notices whose shingles some window of their tier holds: all windows against all notices."""
    def cut(t):
        own = re.findall(r"[^\W_]+", (t or "").lower())
        return own, [tuple(own[i:i + size]) for i in range(len(own) - size + 1)]
    _, own = cut(text)
    found = {}
    for name, notice in notices:
        length, needed = len(cut(notice)[0]), set(cut(notice)[1])
        if not needed:
            continue
        longest = 1 << max(1, (length - 1).bit_length())
        shares = [len(needed & set(own[b:b + 2 * longest - size + 1])) / len(needed) for b in range(0, len(own), longest)]
        if max(shares, default=0) >= containment:
            found[name] = max(shares)
    return found


def test_windows_equal_brute_force(spark):
    texts = []
    for i in range(60):
        text = words(i, 5 + i * 3).split()
        for j, (_, notice) in enumerate(license_scan.NOTICES):
            if (i + j) % 5 == 0:
                own = notice.split()
                if i % 3 == 0:
                    own = own[1:] or own
                text[(i * 7) % len(text):0] = own
        texts.append((", " if i % 2 else " ").join(text).upper() if i % 7 == 0 else "\n".join(text))
    texts += [n for _, n in license_scan.NOTICES] + ["", None, "mit license", "All rights", "all RIGHTS   reserved"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in license_scan.find_notices(docs).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.containment
    assert got == {i: f for i, t in enumerate(texts) if (f := plain(t, license_scan.NOTICES))}


@pytest.mark.parametrize("window,least", [(6, 1), (14, 3), (30, 7)])
def test_bands_guarantee_the_collision(window, least):
    bands = license_scan.bands_for(window, least, 0.8, 1e-4)
    common = math.ceil(0.8 * least)
    assert (1 - common / (window + least - common)) ** bands <= 1e-4


def test_the_plan_has_no_python(spark, odd_documents):
    plan = license_scan.find_notices(odd_documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_odd_rows(spark, odd_documents, no_documents):
    assert license_scan.find_notices(odd_documents).count() == 0
    assert license_scan.find_notices(no_documents).count() == 0
    assert license_scan.find_notices(odd_documents, (("short", "two words"),)).count() == 0
    marked = odd_documents.withColumn("text", F.concat(F.lit("Released under the MIT License. "), "text"))
    rows = license_scan.find_notices(marked).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, [*range(1, 10), None]))
    assert {(r.license, r.first_word, r.containment) for r in rows} == {("MIT", 0, 1.0)}
