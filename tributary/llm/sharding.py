"""Sharding by sampled splitters.

Records are ordered by a digest of their content and, inside large groups of
equal content, by their id. A sample in which a record's chance grows with its
size gives quantiles as range boundaries; ranges that still come out overfull
are subdivided from a denser sample of their own records. Exact sums of the
ranges and running sums inside each then cut the order into shards of nearly
equal bytes. The few records and groups that are large beside a shard are
placed first, so that no cut has to fall inside one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.staging import stage

#: Groups of equal content above this share of a shard are placed before all others.
GROUP_SHARE = 0.01
#: Groups up to this share of a shard are placed whole.
WHOLE_SHARE = 0.1
#: Splitters are bounded, so that they fit in every task.
MAX_RANGES = 1 << 16


def text_size(text) -> F.Column:
    """UTF-8 bytes plus 1; a null counts as empty."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc32(text) -> F.Column:
    """Unsigned CRC-32 of the UTF-8 bytes; a null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _range_of(keys: np.ndarray, subs: np.ndarray):
    """Number of boundaries (key, sub) that are not above a record's; boundaries ascend."""
    hot, first, count = np.unique(keys, return_index=True, return_counts=True)

    @F.pandas_udf(T.IntegerType())
    def range_of(key: pd.Series, sub: pd.Series) -> pd.Series:
        key, sub = key.to_numpy(), sub.to_numpy()
        out = np.searchsorted(keys, key, "left")
        at = np.searchsorted(hot, key)
        same = np.flatnonzero((at < len(hot)) & (hot[np.minimum(at, len(hot) - 1)] == key)) if len(hot) else []
        for group in np.unique(at[same]) if len(same) else ():
            rows = same[at[same] == group]
            inside = subs[first[group]:first[group] + count[group]]
            out[rows] = first[group] + np.searchsorted(inside, sub[rows], "right")
        return pd.Series(out.astype("int32"))

    return range_of


def _quantile_keys(sample: pd.DataFrame, share: float) -> list[tuple[int, int]]:
    """Keys at which the sample's weight passes multiples of `share`."""
    sample = sample.sort_values(["key", "sub"])
    passed = np.floor(sample.weight.cumsum().to_numpy() / share)
    at = np.flatnonzero(np.diff(passed, prepend=0.0) > 0)
    return list(zip(sample.key.to_numpy()[at].tolist(), sample["sub"].to_numpy()[at].tolist(), strict=True))


def _draw(rows: DataFrame, step: float, seed: int) -> pd.DataFrame:
    """Each row with chance size / step, standing for at least `step` bytes. The same rows whenever a task is repeated."""
    chance = F.pmod(F.xxhash64("id", "key", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return (rows.filter(chance < F.col("size") / F.lit(step))
            .select("key", "sub", F.greatest(F.col("size").cast("double"), F.lit(step)).alias("weight")).toPandas())


def _place_bulky(groups: pd.DataFrame, shards: int, fair: float) -> tuple[pd.DataFrame, list[int], np.ndarray]:
    """Groups to be placed whole, largest first to the emptiest shard; keys to be cut; bytes left free in each shard."""
    whole = groups[(groups.bytes <= WHOLE_SHARE * fair) | (groups.n == 1)].sort_values(["bytes", "key"], ascending=[False, True])
    load, shard = np.zeros(shards), []
    for size in whole.bytes:
        shard.append(int(load.argmin()))
        load[shard[-1]] += size
    placed = pd.DataFrame({"key": whole.key.to_numpy("int64"), "placed": np.array(shard, "int32"),
                           "group": np.arange(len(whole), dtype="int32")})
    free = np.maximum(0, max(fair, load.max(initial=0)) - load)
    return placed, groups[~groups.key.isin(whole.key)].key.tolist(), free


def shard_by_bytes(records: DataFrame, shards: int, rows_per_range: int = 100_000,
                   samples_per_range: int = 32) -> DataFrame:
    """Records with `shard` (0 to shards - 1, sizes near equal) and `slot` (gapless from 0 in each shard).

    `records` has the longs id, key (digest of the content) and size (1 or more); further columns stay. Keys holding
    over 1 % of a shard, at most shards * 100 of them, are placed first: whole up to a tenth of a shard, cut along
    their ids beyond that. All others follow the order of keys into what room is left, records of one key together.
    Null ids and keys come first in the order. Repeated rows are records of their own. An empty table stays empty.
    At most 65,536 ranges with 32 sampled keys each reach the driver, whatever the size.
    """
    spark = records.sparkSession
    lowest = F.lit(-(1 << 63))
    extra = [c for c in records.columns if c not in ("id", "key", "size")]
    rows = stage(records.select(F.coalesce("id", lowest).alias("id"), F.coalesce("key", lowest).alias("key"), "size",
                                F.struct("id", *extra).alias("kept")), "shard-records")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    fair = max(total / shards, 1)
    groups = (rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
              .filter(F.col("bytes") > GROUP_SHARE * fair).toPandas())
    placed, cut, free = _place_bulky(groups, shards, fair)
    rows = rows.join(F.broadcast(spark.createDataFrame(placed, "key long, placed int, group int")), "key", "left")
    rows = rows.withColumn("sub", F.when(F.col("key").isin(cut), F.col("id")).otherwise(0) if cut else F.lit(0).cast("long"))

    loose = rows.filter("placed IS NULL")
    wanted = min(MAX_RANGES, max(16 * shards, count // rows_per_range))
    share = max(total / wanted, 1)
    bounds = _quantile_keys(_draw(loose, share / samples_per_range, 0), share)
    for attempt in range(1, 4):
        ranged, sizes = _measure(rows, bounds)
        overfull = np.flatnonzero((sizes.bytes > 2 * share) & (sizes.n > 1) & (sizes.index <= len(bounds)))
        if not len(overfull) or len(bounds) >= MAX_RANGES:
            break
        dense = _draw(ranged.filter(F.col("range").isin(sizes.index[overfull].tolist())),
                      share / samples_per_range / 4**attempt, attempt)
        finer = sorted({*bounds, *_quantile_keys(dense, share)})
        if finer == bounds:
            break
        bounds = finer
    ranged, sizes = _measure(rows, bounds)

    sizes = sizes[sizes.index <= len(bounds)]
    before = spark.createDataFrame(pd.DataFrame({"range": sizes.index.astype("int32"), "bytes_before": (
        sizes.bytes.cumsum() - sizes.bytes).to_numpy("int64")}), "range int, bytes_before long")
    scale = sizes.bytes.sum() / max(free.sum(), 1)
    edges = [float(x) for x in np.cumsum(free)[:-1] * scale]
    order = Window.partitionBy("range").orderBy("key", "sub")
    running = F.sum("size").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    middle = F.col("bytes_before") + F.col("through") - F.col("size") / 2
    shard = sum((F.when(middle > edge, 1).otherwise(0) for edge in edges), F.lit(0))
    places = (ranged.withColumn("through", running)
              .withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy("key", "sub", "id")))
              .join(F.broadcast(before), "range", "left")
              .select("kept", "key", "size", "range", "place", F.coalesce("placed", shard).cast("int").alias("shard")))
    places = stage(places, "shard-places")
    parts = places.groupBy("shard", "range").agg(F.min("place").alias("first"), F.count("*").alias("n")).toPandas()
    parts = parts.sort_values(["shard", "range"])  # at most ranges + shards * 100 rows
    parts["shift"] = parts.groupby("shard").n.cumsum() - parts.n - parts["first"]
    shifts = spark.createDataFrame(parts[["shard", "range", "shift"]], "shard int, range int, shift long")
    return places.join(F.broadcast(shifts), ["shard", "range"]).select(
        "kept.*", "key", "size", "shard", (F.col("place") + F.col("shift")).alias("slot"))


def _measure(rows: DataFrame, bounds: list[tuple[int, int]]) -> tuple[DataFrame, pd.DataFrame]:
    """Rows with their range, each group placed whole in one of its own behind the others; bytes and rows of the ranges."""
    keys = np.array([k for k, _ in bounds], np.int64)
    subs = np.array([s for _, s in bounds], np.int64)
    own = F.lit(len(bounds) + 1) + F.col("group")
    ranged = rows.withColumn("range", F.coalesce(own, _range_of(keys, subs)("key", "sub")))
    sizes = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).toPandas()
    return ranged, sizes.sort_values("range").set_index("range")


def write_shards(records: DataFrame, shards: DataFrame, path: str, id_column: str, rows_per_file: int = 100_000) -> None:
    """Write whole records under `path`/shard=N, in slot order, as files of at most `rows_per_file` rows. Ids are unique."""
    places = shards.select(F.col("id").alias(id_column), "shard", "slot")
    (records.join(places, id_column)
     .withColumn("_file", F.floor(F.col("slot") / rows_per_file))
     .repartition(F.col("shard"), F.col("_file")).sortWithinPartitions("shard", "slot")
     .drop("_file").write.partitionBy("shard").parquet(path))


def shard_documents(documents: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all documents."""
    records = documents.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
                               text_size(F.col("text")).alias("size"), text_crc32(F.col("text")).alias("text_crc32"))
    return shard_by_bytes(records, shards).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
