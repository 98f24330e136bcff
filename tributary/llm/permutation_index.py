"""Nearest vectors by a permutation index.

Every distinct vector is represented by the order of its nearest pivots, and
keeps the smallest ids that have it beside it. Blocks of distinct vectors hold
a file for each pivot: the place that each vector gives it. A query walks
the files of its own pivots, adds up how well places agree, which is the
footrule distance of the two orders, and the best tenth of a block is ranked
again by the exact inner product. Only then do vectors become ids, so that
copies neither fill the tenth nor use up pivots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.staging import stage

PIVOTS = 256
#: Nearest pivots that represent a vector.
PREFIX = 128
#: Share of a block, and least number of its vectors, that are ranked again.
RERANKED, LEAST_RERANKED = 0.1, 256
#: Distinct vectors and queries of a block.
BLOCK, QUERY_BLOCK = 16384, 4096
#: Bytes of vectors that a task holds while it brings equal ones together.
GATHERED = 1 << 25


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _orders(vectors: np.ndarray, pivots: np.ndarray, extra: np.ndarray, prefix: int) -> np.ndarray:
    """Nearest pivots of each vector, nearest first. `extra` is the last coordinate of the vectors, that of the pivots ends their rows."""
    near = vectors @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1]
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype(np.uint16)


def _matrix(values: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _gather(batches: Iterator[pa.RecordBatch], size: int, kept: int) -> Iterator[pa.RecordBatch]:
    """Vectors, as bytes, with the `kept` smallest ids of a task that have them; a vector comes again only after GATHERED bytes of others."""
    held: dict[bytes, set[int]] = {}

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array([sorted(i)[:kept] for i in held.values()], pa.list_(pa.int64()))],
                                          ["v", "ids"])

    for batch in batches:
        for number, vector in zip(batch.column("id").to_pylist(), _as_bytes(batch, size), strict=True):
            own = held.setdefault(vector, set())
            own.add(number)
            if len(own) > 4 * kept:
                held[vector] = set(sorted(own)[:kept])
        if len(held) * size * 8 > GATHERED:
            yield rows()
            held.clear()
    yield rows()


def _as_bytes(batch: pa.RecordBatch, size: int) -> list[bytes]:
    """The vectors as bytes, alike for equal ones: there is no negative zero."""
    values = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(batch), size) + 0.0
    return [v.tobytes() for v in values]


def search_block(ids: list[np.ndarray], vectors: np.ndarray, orders: np.ndarray, pivots: int, query_ids: np.ndarray,
                 queries: np.ndarray, query_orders: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of the k nearest in the block, equal distances by smaller id; `ids` has the ids of each vector."""
    prefix = orders.shape[1]
    weight = np.uint16 if prefix < 256 else np.int64  # holds their sum
    # A file has the number of places from a pivot's place to the prefix's end, none where it has no place.
    files = np.zeros((pivots, len(ids)), weight)
    files[orders, np.arange(len(ids))[:, None]] = np.arange(prefix, 0, -1, dtype=weight)
    # One more than are wanted, for the query's own vector.
    count = min(len(ids), max(LEAST_RERANKED, int(len(ids) * RERANKED), 2 * k) + 1)
    for query_id, query, order in zip(query_ids, queries, query_orders, strict=True):
        # The footrule distance is a constant less twice this sum over shared pivots.
        agreement, common = np.zeros((2, len(ids)), weight)
        for place, pivot in enumerate(order):
            np.minimum(files[pivot], weight(prefix - place), out=common)
            agreement += common
        chosen = np.arange(len(ids))
        if count < len(ids):  # equal agreement by order in the block
            chosen = np.argpartition(-(agreement.astype(np.int64) * len(ids) - chosen), count - 1)[:count]
        scores = (vectors[chosen] * query).sum(axis=1)  # row by row alike, so that equal vectors get equal scores
        order = np.argsort(-scores, kind="stable")
        chosen, scores = chosen[order], scores[order]
        taken = k + 1
        while True:  # an id that has several vectors counts once, so more of them may be needed
            end = int(np.searchsorted(-scores, -scores[min(taken, len(scores)) - 1], "right"))
            found = np.concatenate([ids[i] for i in chosen[:end]])
            own = np.repeat(scores[:end], [len(ids[i]) for i in chosen[:end]])
            by_score = np.lexsort((found, -own))
            by_score = by_score[found[by_score] != query_id]
            firsts = np.sort(np.unique(found[by_score], return_index=True)[1])
            if len(firsts) >= k or end == len(scores):
                break
            taken *= 2
        best = by_score[firsts[:k]]
        yield query_id, found[best], own[best]


def nearest(vectors: DataFrame, queries: Column, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 20,
            pivots: int = PIVOTS, prefix: int = PREFIX, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where `queries` holds, the k nearest of all others by inner product.

    Scores are exact in double precision, equal ones go by smaller id. Vectors that are null, zero or hold null or
    non-finite components, rows without id and vectors of another length than most take no part. A row does not find
    rows of its own id; rows repeating an id count as one candidate, with the best score. With fewer candidates than k
    all are returned; an empty table gives no row. Equal vectors are one in the index, whatever their number; pivots
    are the distinct vectors with the smallest hashes.
    """
    rows = (vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"),
                           F.coalesce(queries, F.lit(False)).alias("asks"))
            .filter(F.col("id").isNotNull() & usable(F.col("v"))))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(
        F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("asking"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("longest")).orderBy(F.desc("n"), "size").limit(1).collect()
    fields = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return vectors.sparkSession.createDataFrame([], fields)
    size, _, asking, longest = sizes[0]
    rows = rows.filter(F.size("v") == size)
    kept = k + 1  # a query leaves out its own id

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gather(batches, size, kept)

    smallest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, kept)
    distinct = stage(rows.select("id", "v").mapInArrow(gather, "v binary, ids array<long>").groupBy("v").agg(smallest.alias("ids")), "vectors")
    count = distinct.count()
    sample = distinct.select("v").orderBy(F.xxhash64("v"), "v").limit(pivots).toPandas()
    table = _matrix(sample.v.tolist(), "f8") / np.sqrt(longest)
    table = np.column_stack([table, np.sqrt(np.maximum(0, 1 - (table**2).sum(axis=1)))])
    prefix = min(prefix, len(table))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                scaled = _matrix(batch.column("v").to_pylist(), "f8") / np.sqrt(longest)
                # Vectors are lifted to one length, so that a larger inner product is a smaller distance; queries are not.
                orders = _orders(scaled, table, np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1))), prefix)
                yield batch.append_column("pivots", pa.array([o.tobytes() for o in orders], pa.binary()))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                own = _as_bytes(batch, size)
                orders = _orders(_matrix(own, "f8") / np.sqrt(longest), table, np.zeros(len(batch)), prefix)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(own, pa.binary()),
                                                  pa.array([o.tobytes() for o in orders], pa.binary())], ["id", "v", "query_pivots"])

    blocks, query_blocks = -(-count // block), max(1, -(-asking // QUERY_BLOCK))

    def parts(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = distinct.mapInArrow(index, "v binary, ids array<long>, pivots binary").select(
        "v", "ids", "pivots", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int").alias("block"), parts(query_blocks).alias("query_block"))
    asked = rows.filter("asks").select("id", "v").distinct().mapInArrow(ask, "id long, v binary, query_pivots binary").select(
        "id", "v", "query_pivots", parts(blocks).alias("block"),
        F.pmod(F.xxhash64("id", "v"), F.lit(query_blocks)).cast("int").alias("query_block"))

    def search(own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(queries):
            own = own.sort_values("v", kind="stable")
            found = search_block(own.ids.tolist(), _matrix(own.v.tolist(), "f8"), _matrix(own.pivots.tolist(), "u2"), len(table),
                                 queries.id.to_numpy(), _matrix(queries.v.tolist(), "f8"), _matrix(queries.query_pivots.tolist(), "u2"), k)
            out = [pd.DataFrame({"query_id": q, "vec_id": ids, "score": scores}) for q, ids, scores in found]
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = candidates.groupBy("block", "query_block").cogroup(asked.groupBy("block", "query_block")).applyInPandas(
        search, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
