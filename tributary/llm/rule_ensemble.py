"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on labelled rows; every path from a root is a rule, a
conjunction of bounds on statistics. A logistic regression with an L1 penalty
gives most rules the weight zero, and the rest is compiled into one Spark
column expression, so that scoring is a plain projection.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.staging import stage

#: Labelled rows that the model is fitted on, at most about this many, chosen by a hash of their doc_id.
MAX_LABELLED = 30_000
TREES, DEPTH, PENALTY = 10, 3, 1e-3

_SIGNS = "!|#$%&*"


def statistics(text: Column, words: Column) -> dict[str, Column]:
    """Statistics of a text that is not null and its words; shares are of characters or words and 0 for an empty text."""
    chars, count = F.length(text), F.size(words)

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0)).cast("double")

    def without(sign: str) -> Column:
        return chars - F.length(F.replace(text, F.lit(sign), F.lit("")))

    repeats = F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1))))
    return {
        "chars": chars.cast("double"),
        "words": count.cast("double"),
        "word_length": share(chars, count),
        "distinct_words": share(F.size(F.array_distinct(words)), count),
        "repeated_words": share(repeats, count),
        "capitals": share(F.regexp_count(text, F.lit(r"\p{Lu}")), chars),
        "digits": share(F.regexp_count(text, F.lit(r"[0-9]")), chars),
        "lines": share(without("\n"), count),
        "stops": share(without("."), count),
        **{f"sign_{i}": share(without(sign), chars) for i, sign in enumerate(_SIGNS)},
    }


@dataclass(frozen=True)
class Rule:
    """Bounds (above, up to) by statistic: the rule holds if above < value <= up to for all."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self, source: str) -> Column:
        tests = []
        for name, above, up_to in self.bounds:
            value = F.col(f"{source}.{name}")
            tests += ([value > above] if above > -math.inf else []) + ([value <= up_to] if up_to < math.inf else [])
        held = tests[0]
        for test in tests[1:]:
            held = held & test
        return held


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, source: str = "stats") -> Column:
        """Probability of label 1 from the struct `source` of statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(source), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def tree_rules(trees: str, names: list[str]) -> list[Rule]:
    """Rules of all paths of an ensemble's textual description, each once, in its order."""
    rules: dict[Rule, None] = {}
    path: list[tuple[str, str, float]] = []
    for line in trees.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if re.match(r" *Tree \d+", line):
            path, depth_of = [], {}
        if not found:
            continue
        indent = len(found[1])
        depth = depth_of.setdefault(indent, len(depth_of))
        path = [*path[:depth], (names[int(found[2])], found[3], float(found[4]))]
        bounds: dict[str, list[float]] = {}
        for name, sign, value in path:
            low_high = bounds.setdefault(name, [-math.inf, math.inf])
            if sign == ">":
                low_high[0] = max(low_high[0], value)
            else:
                low_high[1] = min(low_high[1], value)
        rules[Rule(tuple((n, *b) for n, b in sorted(bounds.items())))] = None
    return list(rules)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(rows: DataFrame, names: list[str], trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> RuleModel:
    """Model from rows with the struct `stats` and `label` 0 or 1.

    With labels of one kind only, the score is their share, a half without any.
    """
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = min(max(next(iter(counts), 0.5), 1e-6), 1 - 1e-6)
        return RuleModel(math.log(share / (1 - share)), ())
    values = F.array(*(F.col(f"stats.{n}") for n in names))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=max(1, min(20, sum(counts.values()) // 100)),
                                    seed=11, featureSubsetStrategy="onethird").fit(
        rows.select(array_to_vector(values).alias("features"), F.col("label").cast("double").alias("label")))
    rules = tree_rules(forest.toDebugString, names)
    if not rules:
        share = counts.get(1, 0) / sum(counts.values())
        return RuleModel(math.log(share / (1 - share)), ())
    held = F.array(*(r.column("stats").cast("double") for r in rules))
    held = stage(rows.select(held.alias("held"), F.col("label").cast("double").alias("label")), "held-rules")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=50).fit(
        held.select(array_to_vector("held").alias("features"), "label"))
    weights = [float(w) for w in lasso.coefficients.toArray()]
    return RuleModel(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights, strict=True) if w))


def with_statistics(documents: DataFrame, *kept: Column) -> DataFrame:
    """The given columns and the struct `stats`; computed once a row, whatever is asked of it afterwards."""
    text = F.coalesce("text", F.lit(""))
    stats = F.struct(*(c.alias(n) for n, c in statistics(F.col("_parts.text"), F.col("_parts.words")).items()))
    # Generated structs keep later expressions from being moved below, where they would repeat the words and statistics.
    parts = F.explode(F.array(F.struct(text.alias("text"), F.split(F.trim(text), r"\s+").alias("words"))))
    return documents.select(F.struct(*kept).alias("_kept"), parts.alias("_parts")).select(
        "_kept", F.explode(F.array(stats)).alias("stats")).select("_kept.*", "stats")


def fit_on_labels(measured: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> RuleModel:
    """Model from `measured` (doc_id, stats) and `labels` (doc_id, quality) without the held-out rows.

    Labels other than 0 and 1 and rows without doc_id are left out; repeated labels count once, contrary ones both.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct())
    count = known.count()
    if count > most:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * most / count))
    rows = stage(measured.select("doc_id", "stats").join(known, "doc_id").select("stats", "label"), "labelled")
    return fit(rows, rows.schema["stats"].dataType.fieldNames())


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each document; empty and null texts are scored by the same rules.

    Only the text is an input of a score. Repeated rows are scored each; a row without doc_id is not held out.
    """
    measured = stage(with_statistics(documents, F.col("doc_id").cast("long").alias("doc_id")), "statistics")
    score = fit_on_labels(measured, labels).score()
    return measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents without those whose score is below a half."""
    measured = stage(with_statistics(documents, F.col("doc_id").cast("long").alias("doc_id")), "statistics")
    score = fit_on_labels(measured, labels).score()
    return with_statistics(documents, F.struct(*documents.columns).alias("row")).filter(score >= 0.5).select("row.*")
