import math
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import words
from tributary.llm import rule_ensemble
from tributary.llm.rule_ensemble import Rule, RuleModel


@pytest.fixture
def labelled(spark):
    good = [(i, words(i, 40 + i % 30) + ".") for i in range(300)]
    junk = [(300 + i, words(i, 30).upper().replace(" ", "!! ")) for i in range(60)] + [(400 + i, f"{words(i, 1)} " * 50) for i in range(60)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string")
    return docs, docs.select("doc_id", F.when(F.col("doc_id") < 300, 1).otherwise(0).alias("quality"))


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    out = rule_ensemble.score_documents(docs, labels).toPandas()
    assert out.score.between(0, 1).all() and ((out.score >= 0.5) == (out.predicted == 1)).all()
    assert out.held_out.tolist() == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id]
    held = out[out.held_out]
    assert len(held) > 80 and ((held.doc_id < 300) == (held.predicted == 1)).mean() > 0.97
    kept = rule_ensemble.keep_good(docs, labels)
    assert {r.doc_id for r in kept.collect()} == set(out.doc_id[out.predicted == 1]) and kept.columns == docs.columns


def test_held_out_labels_are_not_learned(labelled):
    docs, labels = labelled
    turned = labels.withColumn("quality", F.when(rule_ensemble.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (rule_ensemble.score_documents(docs, x).orderBy("doc_id").collect() for x in (labels, turned))
    assert first == second


def test_rules_are_the_paths_of_the_trees():
    text = """RandomForest
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 0 > 1.5)
     If (feature 0 <= 3.0)
      Predict: 0.0
     Else (feature 0 > 3.0)
      Predict: 1.0
  Tree 1 (weight 1.0):
    If (feature 1 <= 2.0)
     Predict: 0.0
    Else (feature 1 > 2.0)
     Predict: 1.0"""
    up, low = math.inf, -math.inf
    assert [r.bounds for r in rule_ensemble.tree_rules(text, ["a", "b"])] == [
        (("a", low, 1.5),), (("a", low, 1.5), ("b", low, 2.0)), (("a", low, 1.5), ("b", 2.0, up)), (("a", 1.5, up),),
        (("a", 1.5, 3.0),), (("a", 3.0, up),), (("b", low, 2.0),), (("b", 2.0, up),)]


def test_scores_are_compiled_columns(spark):
    model = RuleModel(0.25, ((Rule((("a", 1.0, math.inf), ("b", -math.inf, 5.0))), 2.0), (Rule((("b", 0.0, 3.0),)), -1.0)))
    rows = spark.createDataFrame([(2.0, 5.0), (1.0, 2.0), (2.0, 3.0)], "a double, b double").select(F.struct("a", "b").alias("stats"))
    got = [r[0] for r in rows.select(model.score()).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(-z)) for z in (2.25, -0.75, 1.25)])


def test_statistics(spark, odd_documents):
    docs = spark.createDataFrame([("Ab ab ab x!\n9.",), ("",), (None,), ("  ",)], "text string")
    rows = rule_ensemble.with_statistics(docs, F.col("text")).collect()
    first = rows[0].stats
    assert (first.chars, first.words, first.repeated_words, first.capitals) == (14.0, 5.0, 0.2, 1 / 14)
    assert first.distinct_words == 0.8 and first.lines == 0.2 and first.sign_0 == 1 / 14
    assert rows[1].stats == rows[2].stats and rows[3].stats.words == rows[1].stats.words


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10)] * 2 + [(None, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    out = rule_ensemble.score_documents(odd_documents, labels).toPandas()
    assert len(out) == odd_documents.count() and out.score.notna().all() and not out[out.doc_id.isna()].held_out.any()
    kept = rule_ensemble.keep_good(odd_documents, labels)
    assert kept.schema == odd_documents.schema and kept.count() == (out.predicted == 1).sum()
    assert rule_ensemble.score_documents(no_documents, labels).count() == 0
    none = rule_ensemble.score_documents(odd_documents, labels.filter("false")).toPandas()
    assert none.score.tolist() == pytest.approx([0.5] * len(none))
    ones = rule_ensemble.score_documents(odd_documents, labels.filter("quality = 1")).toPandas()
    assert (ones.predicted == 1).all()
