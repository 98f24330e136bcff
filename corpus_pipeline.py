"""A corpus made ready for training: five stages over the documents, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. All but the last return the columns of the documents. Rows may have nulls,
empty or very long texts, repeated rows and further columns; a row without
doc_id passes the second stage as a document of its own. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import latent_search, odd_sketches, packing, rule_ensemble, secret_scan
from tributary.staging import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on `labels`, does not reject."""
    return rule_ensemble.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, similarity 0.8."""
    return odd_sketches.keep_one_each(docs, words=5, percent=80)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`."""
    return latent_search.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secret_scan.redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", keep_quality),
    ("near_dedup", keep_distinct),
    ("decontamination", keep_clean),
    ("secret_scans", remove_secrets),
    ("packing", pack_sequences),
]

#: The stages hold learned models, hashes and tokenizers, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the result of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"corpus-{name}")
    return docs
