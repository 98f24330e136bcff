"""Registered queries on whole test tables: contracts, SQL counterparts, and the pipeline stage by stage."""

import os
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tributary.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def results(spark):
    return {name: query(spark, FOLDER).toPandas() for name, query in QUERIES.items()}


def plain(rows):
    """Rows with null for any missing value and whole numbers as integers, in order."""
    def value(v):
        if v is None or str(v) in ("<NA>", "nan"):
            return None
        return int(v) if isinstance(v, (float, np.floating)) and v == int(v) else v.item() if isinstance(v, np.generic) else v
    return sorted(repr(tuple(map(value, row))) for row in rows.itertuples(index=False, name=None))


def test_all_are_registered():
    names = set(entry_points.queries())
    assert {*QUERIES, "pipeline"} <= names and set(ORACLES) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "secret_scans", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(results, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    wanted = connection.execute(ORACLES[name]).df()
    got = results[name][list(wanted.columns)]
    assert plain(got) == plain(wanted)


def test_every_row_of_the_tables_has_its_results(spark, results):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas()
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").toPandas()
    for name in ("op1_sampled_splitters", "op6_odd_sketches", "op7_rule_ensemble", "op8_guess_cost", "op12_vertical_fragments"):
        assert sorted(results[name].doc_id) == sorted(documents.doc_id)
    for name in ("op4_page_templates", "op10_zip_archives"):
        assert sorted(results[name].page_id) == sorted(pages.page_id)
    held = results["op7_rule_ensemble"].set_index("doc_id").held_out
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in documents.doc_id)


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    steps = [docs]
    for _, function in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.stage(function(spark, steps[-1], FOLDER), "test-step"))
    for before, after in zip(steps[:4], steps[1:5], strict=False):
        assert after.schema == before.schema
    kept = [s.toPandas().set_index("doc_id") for s in steps[:5]]
    assert set(labels.doc_id[labels.quality == 1]) & set(kept[0].index) <= set(kept[1].index)

    from tests.llm.test_odd_sketches import plain_components, plain_sets

    ids = kept[1].index.tolist()
    component = plain_components(ids, plain_sets(kept[1].text.tolist(), 5), 80)
    assert set(kept[2].index) == {i for i in ids if component[i] == i}
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").toPandas().text.tolist()
    assert set(kept[3].index) == {i for i, t in kept[2].text.items() if not any(x in t for x in items)}
    assert set(kept[4].index) == set(kept[3].index) and (kept[4].text.str.len() == kept[4].n_chars).all()
    packed = steps[5].toPandas()
    assert np.array_equal(np.sort(packed.doc_id.unique()), np.sort(kept[4].index))
    assert (packed.groupby("doc_id").length.sum() == packed.groupby("doc_id").doc_tokens.first()).all()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_the_library_works_without_these_parts():
    """Nothing outside imports the subpackage, and the entry guards its absence alone."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "tributary")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as file:
                        assert "tributary.llm" not in file.read()
