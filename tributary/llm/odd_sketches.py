"""Near-duplicate documents by MinHash bands and odd sketches.

A document is the set of its word shingles. Of 512 MinHash samples the first
quarter gives 32 bands of four for candidates; all of them, folded into a bitmap
by parity, give the odd sketch, whose XOR with another counts the samples that
differ and so tells high similarities apart from low ones at 128 bytes a
document. What remains is confirmed on the full sets.

A pair at similarity 0.8 shares no band with probability 5e-8, and is refused
by its sketches with about 1e-5, one above with less.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.components import components
from tributary.llm.words import mix, shingle_set, text_blocks, words_of
from tributary.staging import stage

BANDS, BAND_ROWS = 32, 4
SAMPLES = 4 * BANDS * BAND_ROWS
SKETCH_BITS = 1024
#: Pairs whose sketches tell of less similarity are not compared in full: over four deviations below 0.8.
LEAST_ESTIMATE = 0.7
#: Members of a bucket that a member still apart is compared with by sketch, and how many of them all in full.
DELEGATES, NEAREST = 8, 4
#: Members of a bucket that meet in one block.
BLOCK = 1024

_generator = np.random.default_rng(20)
_XOR = _generator.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_FACTOR = _generator.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_SALT = np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)
_BAND_FACTOR = _generator.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64).reshape(BANDS, BAND_ROWS) * np.uint64(2) + np.uint64(1)

_SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """The MinHash samples of a non-empty set of 64-bit hashes."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    return np.min([((short[i:i + 2048, None] ^ _XOR) * _FACTOR).min(axis=0) for i in range(0, len(short), 2048)], axis=0)


def band_keys(samples: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band, different from band to band; `samples` has a row for each set."""
    banded = samples[:, :BANDS * BAND_ROWS].astype(np.uint64).reshape(len(samples), BANDS, BAND_ROWS)
    return mix((mix(banded + _SALT[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)) * _BAND_FACTOR).sum(axis=2, dtype=np.uint64))


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Bitmaps as unsigned 64-bit words: bit i is the parity of the samples that hash to it."""
    at = mix(samples.astype(np.uint64) + _SALT) % np.uint64(SKETCH_BITS)
    at += np.arange(len(samples), dtype=np.uint64)[:, None] * np.uint64(SKETCH_BITS)
    counts = np.bincount(at.ravel().astype(np.int64), minlength=len(samples) * SKETCH_BITS)
    bits = (counts & 1).astype(np.uint8).reshape(len(samples), SKETCH_BITS)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def most_differing_bits(similarity: float) -> int:
    """XOR population count that two sketches of this similarity have on average."""
    differing = 2 * SAMPLES * (1 - similarity)
    return math.floor(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** differing))


def signatures(documents: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (a digest of the set), bands, sketch words of each document.

    A text without words, or a null one, has an empty set, null digests and no bands.
    """
    fields = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
                        ("bands", pa.list_(pa.int64())), *((s, pa.int64()) for s in _SKETCH)])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_blocks(batch.column("text")):
                found = words_of(texts)
                n = len(texts)
                sizes, digests, samples = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64), np.zeros((n, SAMPLES), np.uint32)
                for i in range(n):
                    own = shingle_set(found.hash[found.starts[i]:found.starts[i + 1]], words)
                    sizes[i] = len(own)
                    if len(own):
                        digests[i] = own.sum(), mix(own ^ np.uint64(len(own))).sum()
                        samples[i] = min_hashes(own)
                empty = sizes == 0
                keys, sketch = band_keys(samples).view(np.int64), odd_sketch(samples).view(np.int64)
                offsets = np.arange(n + 1, dtype=np.int32) * BANDS
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()), mask=pa.array(empty))
                signed = digests.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), pa.array(sizes), pa.array(signed[:, 0], mask=empty),
                     pa.array(signed[:, 1], mask=empty), bands, *(pa.array(sketch[:, i], mask=empty) for i in range(len(_SKETCH)))],
                    schema=fields)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sign, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, " + ", ".join(f"{s} long" for s in _SKETCH))


def _differing(left: str, right: str) -> F.Column:
    return sum(F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))) for s in _SKETCH)


def _alike(left: str, right: str, percent: int) -> F.Column:
    """Whether sizes and sketches allow the similarity."""
    small, large = F.least(f"{left}.n", f"{right}.n"), F.greatest(f"{left}.n", f"{right}.n")
    return (small * 100 >= large * percent) & (_differing(left, right) <= most_differing_bits(LEAST_ESTIMATE))


def _join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two tables that grow with the corpus: neither is sent to all tasks, whatever its size."""
    return left.join(right.hint("merge"), on, how)


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity; `texts` has id and text."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep, ids_b = np.zeros(len(batch), bool), batch.column("b").to_pylist()
            for first, block in text_blocks(batch.column("text_a")):
                found = words_of(block)
                for i in range(len(block)):
                    if ids_b[first + i] != last:  # rows come in the order of b
                        last = ids_b[first + i]
                        (_, other), = text_blocks(batch.column("text_b").slice(first + i, 1))
                        held = shingle_set(words_of(other).hash, words)
                    own = shingle_set(found.hash[found.starts[i]:found.starts[i + 1]], words)
                    both = np.concatenate([own, held])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    keep[first + i] = 100 * common >= percent * (len(own) + len(held) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    both = _join(_join(pairs, texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a"),
                 texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return stage(both.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long"), "near-links")


def _pair(left: str, right: str) -> list[F.Column]:
    return [F.greatest(left, right).alias("a"), F.least(left, right).alias("b")]


def _nearest_delegates(rest: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """For each member outside its leader's component, the delegates in other components whose sketches are nearest."""
    own = F.struct("id", "n", "component", *_SKETCH)
    slot = F.pmod(F.xxhash64("id", "band"), F.lit(DELEGATES))
    delegates = rest.groupBy("band", slot.alias("slot")).agg(F.min(F.struct(F.xxhash64("id").alias("turn"), own.alias("own"))).alias("least"))
    main = rest.filter("id = leader").select("band", F.col("component").alias("main"))
    seeking = _join(rest, main, "band", "left").filter(~F.col("component").eqNullSafe(F.col("main")))
    offered = (_join(seeking.select("band", own.alias("l")), delegates.select("band", F.col("least.own").alias("r")), "band")
               .filter((F.col("l.component") != F.col("r.component")) & _alike("l", "r", percent))
               .select("l.id", F.struct(_differing("l", "r").alias("differing"), F.col("r.id").alias("other")).alias("offer")))
    best = offered.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("offer")), 1, NEAREST).alias("best"))
    pairs = best.select("id", F.explode("best.other").alias("other")).select(*_pair("id", "other")).distinct()
    return _join(pairs, tried, ["a", "b"], "left_anti")


def _all_apart(rest: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket in different components, in blocks of members, but for those tried before."""
    rest = (rest.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    own = F.struct("id", "n", "component", "bands", *_SKETCH)
    left = rest.select("band", F.col("block").alias("i"), other.alias("j"), own.alias("l")).filter("j >= i")
    right = rest.select("band", other.alias("i"), F.col("block").alias("j"), own.alias("r")).filter("i <= j")
    # Two documents may share many bands; they meet in the least one alone.
    least = F.array_min(F.array_intersect("l.bands", "r.bands")) == F.col("a.band")
    apart = ((F.col("l.component") != F.col("r.component")) & ((F.col("a.i") != F.col("a.j")) | (F.col("l.id") < F.col("r.id")))
             & _alike("l", "r", percent) & least)
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("band", "i", "j")]
    pairs = (left.alias("a").join(right.hint("merge").alias("b"), same[0] & same[1] & same[2] & apart)
             .select(*_pair("l.id", "r.id")).distinct())
    return _join(pairs, tried, ["a", "b"], "left_anti")


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each document.

    Documents whose sets of shingles of `words` words reach `percent` % of similarity (intersection by union) are
    linked; component_id is the smallest doc_id that links reach, kept tells whether it is the own one. A text with
    fewer words is one shingle. Empty and null texts are linked with nothing. A row without doc_id takes no part: its
    component is null and it is kept. Repeated rows get the same result; rows of one doc_id with different texts follow
    their own text. Columns beside doc_id and text are not read; an empty table stays empty.

    Equal sets are one class and compared once. In a bucket of a band, members are compared with the smallest one.
    Those that stay apart then try the delegates of their buckets that their sketch is nearest to; at last all members
    of a bucket that are still in different components are compared with each other, in blocks.
    """
    documents = documents.select("doc_id", "text")
    signed = stage(signatures(documents, words), "signatures")
    classes = stage(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b", F.col("n_shingles").alias("n"))
        .agg(F.min("doc_id").alias("id"), *(F.first(c).alias(c) for c in ["bands", *_SKETCH])), "classes")
    sketches = classes.select("id", "n", "bands", *_SKETCH)
    banded = classes.select("id", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("id").alias("leader"), F.count("*").alias("members")).filter("members > 1")
    members = stage(_join(banded, buckets, "band"), "bucket-members")

    stars = stage(members.filter("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct(), "star-pairs")
    likely = _join(_join(stars, sketches.select(F.col("id").alias("a"), F.struct("n", *_SKETCH).alias("l")), "a"),
                   sketches.select(F.col("id").alias("b"), F.struct("n", *_SKETCH).alias("r")), "b")
    likely = stage(likely.filter(_alike("l", "r", percent)).select("a", "b").distinct(), "near-pairs")
    met = members.select("id").distinct()
    texts = stage(_join(documents.select(F.col("doc_id").cast("long").alias("id"), "text"), met, "id", "left_semi"), "member-texts")
    tried = stars
    found = stage(components(_confirm(likely, texts, words, percent)), "components")
    for candidates in (_nearest_delegates, _all_apart):
        placed = _join(members, found.withColumnRenamed("node", "id"), "id", "left").select(
            "id", "band", "leader", "members", F.coalesce("component", "id").alias("component"))
        placed = stage(placed, "placed-members")
        apart = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
        rest = stage(_join(_join(placed, apart, "band", "left_semi"), sketches, "id"), "members-apart")
        pairs = stage(candidates(rest, tried, percent), "near-pairs")
        if not pairs.take(1):
            continue
        more = _confirm(pairs, texts, words, percent)
        tried = tried.union(pairs)
        if more.take(1):  # the components found so far are stars already
            found = stage(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "components")

    named = _join(classes.select("set_a", "set_b", F.col("n").alias("n_shingles"), "id"),
                  found.withColumnRenamed("node", "id"), "id", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "id").alias("component"))
    result = _join(signed.select("doc_id", "n_shingles", "set_a", "set_b"), named, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one_each(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near duplicates, the one with the smallest doc_id of each group staying.

    Rows without doc_id stay. Of rows that repeat a doc_id and text one stays.
    """
    ids = near_duplicates(documents, words, percent).filter("doc_id IS NOT NULL")
    ids = stage(ids.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n")).filter("kept"), "kept-ids")
    once = documents.join(ids.filter("n = 1").select("doc_id"), "doc_id", "left_semi")
    again = documents.join(ids.filter("n > 1").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return (once.unionByName(again) if ids.filter("n > 1").limit(1).count() else once).select(documents.columns).union(
        documents.filter("doc_id IS NULL"))
