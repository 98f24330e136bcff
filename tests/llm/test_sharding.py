import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import words
from tributary.llm import sharding


def check(rows: pd.DataFrame, shards: int):
    assert rows.shard.between(0, shards - 1).all()
    for _, part in rows.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_sizes_are_near_equal_whatever_groups_there_are(spark):
    draw = np.random.default_rng(0)
    rows = pd.DataFrame({"id": np.arange(6000), "key": draw.integers(-2**62, 2**62, 6000), "size": draw.integers(1, 4000, 6000)})
    rows.loc[:2000, "key"] = 17  # a third of all rows
    rows.loc[2001:2100, "key"] = 18
    rows.loc[5000, "size"] = 300_000
    out = sharding.shard_by_bytes(spark.createDataFrame(rows), 16, rows_per_range=100).toPandas()
    check(out, 16)
    sums = out.groupby("shard")["size"].sum()
    assert len(out) == 6000 and len(sums) == 16
    assert sums.max() < 1.03 * sums.mean() and sums.min() > 0.97 * sums.mean()
    assert out[out.key == 18].shard.nunique() == 1


def test_overfull_ranges_are_subdivided():
    udf = sharding._range_of(np.array([5, 9, 9, 9]), np.array([0, 3, 7, 11])).func
    found = udf(pd.Series([4, 5, 8, 9, 9, 9, 9, 10]), pd.Series([0, 0, 0, 2, 3, 8, 20, 0]))
    assert found.tolist() == [0, 1, 1, 1, 2, 3, 4, 4]


def test_documents_get_size_digest_and_slot(odd_documents):
    out = sharding.shard_documents(odd_documents).toPandas()
    texts = odd_documents.select("doc_id", "text").toPandas()
    check(out, 16)
    assert len(out) == len(texts)
    expected = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(texts.doc_id, texts.text, strict=True))
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for _, r in out.iterrows()) == expected
    assert set(out.law) == {"bytes"} and out.grown_shard.isna().all()


def test_an_empty_table_stays_empty(no_documents):
    assert sharding.shard_documents(no_documents).count() == 0


def test_same_input_gives_same_shards(spark):
    docs = spark.createDataFrame([(i, words(i % 50, 30)) for i in range(400)], "doc_id long, text string")
    first = sharding.shard_documents(docs).orderBy("doc_id").collect()
    assert first == sharding.shard_documents(docs.repartition(7)).orderBy("doc_id").collect()


@pytest.mark.parametrize("rows_per_file", [3, 1000])
def test_shards_are_written_whole(spark, tmp_path, rows_per_file):
    docs = spark.createDataFrame([(i, words(i, 20)) for i in range(60)], "doc_id long, text string")
    placed = sharding.shard_documents(docs, 4).withColumnRenamed("doc_id", "id")
    sharding.write_shards(docs, placed, str(tmp_path / "out"), "doc_id", rows_per_file)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select("doc_id", "text").collect())) == sorted(map(tuple, docs.collect()))
    assert back.groupBy("shard").agg(F.max("slot"), F.count("*")).count() == 4
