"""Jaccard join of documents by vertical partitioning of the n-gram order.

A document is the set of its word n-grams. All n-grams have one global order: rare ones
first, by the number of documents that hold them where that is large, else by hash. Any
two sets that are similar enough share an n-gram among the first few of both (prefix
filter), so documents meet on these and the most frequent n-grams hardly ever count. Where
the first n-gram they share stands too far back in either, too few follow (position filter).

For the pairs that remain the order is cut into fragments of about equal numbers of
n-grams. Each set falls into one segment a fragment; overlaps of two segments are counted
apart, fragment by fragment, and summed for each pair.

Only components are wanted, so documents that meet on an n-gram are first compared with
some leaders of it: each with the one whose bits are nearest, then with the others that are
not in its component yet. At last all that meet and are still in different components are
compared. Between the two sets of a pair at most a certain number of n-grams may differ. The
parities of 1,024 hashed bits of both sets differ in no more bits than that, so pairs whose
bits differ in more are left out without comparing the sets. Half of so few bits differ in any
two long sets, so these have one to two parity bits for each n-gram besides, which pairs must
pass before the sets are moved. Every step is lossless; the order only decides how many pairs meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.components import components
from tributary.llm.key_filter import key_filter
from tributary.llm.words import mix, shingle_set, text_blocks, words_of
from tributary.staging import stage

WORDS, PERCENT = 4, 85
FRAGMENTS = 4
#: Frequent n-grams whose place in the order is known to all tasks, 9 bytes each.
MOST_FREQUENT = 1 << 20
#: n-grams that a task counts at a time; it reports those of at least two documents.
_COUNTED_TOGETHER = 1 << 22
#: Steps of the order for each doubling of the number of documents.
_CLASSES_A_DOUBLING = 4
_CLASS_BITS = 8
#: Documents that the others which hold an n-gram are compared with first.
LEADERS = 16
#: Documents of an n-gram that meet in one block.
BLOCK = 1024

_BITS = 1024
_SKETCH = [f"s{i}" for i in range(_BITS // 64)]
#: n-grams of a set above which it has parities of its own size.
LONG = 512


def _sets(batches: Iterator[pa.RecordBatch], words: int, wanted=None) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Ids and n-gram sets (ascending hashes) of documents, block by block; of those whose id `wanted` holds, if given."""
    for batch in batches:
        if wanted is not None:
            batch = batch.filter(pa.array(wanted.holds(batch.column("doc_id").to_numpy(zero_copy_only=False))))
        for first, texts in text_blocks(batch.column("text")):
            found = words_of(texts)
            sets = [shingle_set(found.hash[found.starts[i]:found.starts[i + 1]], words) for i in range(len(texts))]
            yield batch.column("doc_id").slice(first, len(texts)), sets


class GramOrder:
    """The global order of n-grams as unsigned numbers: class of frequency, then hash."""

    def __init__(self, sent):
        self._sent = sent

    def places(self, grams: np.ndarray) -> np.ndarray:
        frequent, classes = self._sent.value
        places = grams >> np.uint64(_CLASS_BITS)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
            classes = np.where(frequent[at] == grams, classes[at], np.uint8(0))
            places |= classes.astype(np.uint64) << np.uint64(64 - _CLASS_BITS)
        return places


def gram_order(documents: DataFrame, words: int, most: int = MOST_FREQUENT) -> tuple[GramOrder, dict[int, int]]:
    """The order by the counts of all documents, and the number of n-grams in each class above 0.

    Counts are those within the parts that a task counts together, without n-grams that only
    one document of a part holds. The `most` most frequent n-grams at most get a class of their
    own; so does none that is held by as many documents as others for which there is no room.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0

        def repeated() -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(gathered), return_counts=True)
            return pa.RecordBatch.from_pydict({"gram": grams[n > 1].view(np.int64), "n": n[n > 1].astype(np.int64)})

        for _, sets in _sets(batches, words):
            gathered += sets
            size += sum(map(len, sets))
            if size >= _COUNTED_TOGETHER:
                yield repeated()
                gathered, size = [], 0
        if size:
            yield repeated()

    last = (1 << _CLASS_BITS) - 1
    level = F.least(F.floor(F.log2("n") * _CLASSES_A_DOUBLING), F.lit(last)).cast("int")
    counts = stage(documents.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).withColumn("class", level), "gram-counts")
    sizes = {r["class"]: (r.grams, r.n) for r in counts.groupBy("class").agg(F.count("*").alias("grams"), F.sum("n").alias("n")).collect()}
    room, least = most, last + 1
    for level in sorted(sizes, reverse=True):  # at most `last` + 1 of them
        room -= sizes[level][0]
        if room < 0:
            break
        least = level
    table = counts.where(F.col("class") >= least).select("gram", "class").toArrow()  # at most `most` rows
    grams = table["gram"].to_numpy().view(np.uint64)
    by_hash = np.argsort(grams)
    sent = documents.sparkSession.sparkContext.broadcast((grams[by_hash], table["class"].to_numpy().astype(np.uint8)[by_hash]))
    return GramOrder(sent), {level: n for level, (_, n) in sizes.items() if level >= least}


def pivots(in_class: dict[int, int], total: int, fragments: int) -> np.ndarray:
    """Places of the order that cut it into fragments of about equal numbers of n-grams; hashes of a class lie evenly."""
    masses = sorted({0: max(total - sum(in_class.values()), 0), **in_class}.items())
    found, behind = [], 0
    for number in range(1, fragments):
        goal = total * number // fragments
        while len(masses) > 1 and behind + masses[0][1] <= goal:
            behind += masses.pop(0)[1]
        level, mass = masses[0]
        share = min((goal - behind) / max(mass, 1), 1.0)
        found.append((level << (64 - _CLASS_BITS)) + int(share * ((1 << (64 - _CLASS_BITS)) - 1)))
    return np.array(found, np.uint64)


def prefix_length(n: int, percent: int) -> int:
    """Number of first n-grams among which a set of n shares one with any set similar enough."""
    return n - -(-n * percent // 100) + 1


def parities(grams: np.ndarray) -> bytes | None:
    """Of a long set the parities of as many hashed bits as the power of two from its size on has, 8 a byte; else None."""
    if len(grams) <= LONG:
        return None
    bits = max(1 << (len(grams) - 1).bit_length(), 64)
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing_parities(left: bytes | None, right: bytes | None) -> int:
    """In how many bits two parities differ, the longer ones folded to the length of the others; 0 if one is None."""
    if left is None or right is None:
        return 0
    a, b = (np.frombuffer(own, np.uint64) for own in (left, right))
    a, b = (np.bitwise_xor.reduce(own.reshape(-1, min(len(a), len(b))), axis=0) for own in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


@F.pandas_udf(T.LongType())
def _differing_parities(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([differing_parities(a, b) for a, b in zip(left, right, strict=True)], dtype="int64")


def _signed(documents: DataFrame, order: GramOrder, words: int, percent: int) -> DataFrame:
    """doc_id, n, id and check (two digests of the set), prefix, sketch words, parities of long sets; digests of empty sets are null."""
    fields = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("id", pa.int64()), ("check", pa.int64()),
                        ("prefix", pa.list_(pa.int64())), *((s, pa.int64()) for s in _SKETCH), ("parities", pa.binary())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, words):
            n = np.array([len(s) for s in sets], np.int64)
            digests, prefixes, empty = np.zeros((len(sets), 2), np.uint64), [], pa.array(n == 0)
            for i, own in enumerate(sets):
                if not len(own):
                    prefixes.append(own)
                    continue
                digests[i] = mix(own ^ np.uint64(len(own))).sum(), mix(own + np.uint64(7 * len(own) + 1)).sum()
                length = prefix_length(len(own), percent)
                prefixes.append(own[np.argsort(order.places(own), kind="stable")[:length]])
            at = np.repeat(np.arange(len(sets)), n) * _BITS + (np.concatenate(sets) >> np.uint64(54)).astype(np.int64)
            odd = (np.bincount(at, minlength=len(sets) * _BITS) & 1).astype(np.uint8).reshape(len(sets), _BITS)
            sketch = np.packbits(odd, axis=1, bitorder="little").view(np.int64)
            starts = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n), *(pa.array(digests[:, i].view(np.int64), mask=n == 0) for i in range(2)),
                 pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(prefixes).view(np.int64)), mask=empty),
                 *(pa.array(sketch[:, i]) for i in range(len(_SKETCH))), pa.array([parities(own) for own in sets], pa.binary())], schema=fields)

    return documents.mapInArrow(sign, "doc_id long, n long, id long, check long, prefix array<long>, "
                                + ", ".join(f"{s} long" for s in _SKETCH) + ", parities binary")


def _join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two tables that grow with the corpus: neither is sent to all tasks, whatever its size."""
    return left.join(right.hint("merge"), on, how)


def _sizes_allow(percent: int) -> Column:
    return F.least("l.n", "r.n") * 100 >= F.greatest("l.n", "r.n") * percent


def _places_allow(percent: int) -> Column:
    """Enough n-grams follow the shared one in both; where a linked pair meets first, it does."""
    return F.least(F.col("l.n") - F.col("l.place"), F.col("r.n") - F.col("r.place")) * (100 + percent) >= (F.col("l.n") + F.col("r.n")) * percent


def _differing() -> Column:
    return sum(F.bit_count(F.col(f"l.{s}").bitwiseXOR(F.col(f"r.{s}"))) for s in _SKETCH)


def _bits_allow(percent: int) -> Column:
    """No more bits differ than n-grams may: of sets x and y at most (100 - percent) (x + y) / (100 + percent)."""
    return _differing() * (100 + percent) <= (F.col("l.n") + F.col("r.n")) * (100 - percent)


def _with_sketches(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and bits allow, and the share of bits that differ."""
    own = F.struct("n", *_SKETCH)
    both = _join(_join(pairs, sketches.select(F.col("id").alias("a"), own.alias("l")), "a"),
                 sketches.select(F.col("id").alias("b"), own.alias("r")), "b")
    return both.where(_sizes_allow(percent) & _bits_allow(percent)).select(
        "a", "b", F.col("l.n").alias("n_a"), F.col("r.n").alias("n_b"), (_differing() / (F.col("l.n") + F.col("r.n"))).alias("apart"))


def _parities_allow(pairs: DataFrame, long: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b, ...) of which one set is not long, or whose parities differ in no more bits than n-grams may."""
    both = _join(_join(pairs, long.select(F.col("id").alias("a"), F.col("parities").alias("l")), "a", "left"),
                 long.select(F.col("id").alias("b"), F.col("parities").alias("r")), "b", "left")
    differing = _differing_parities("l", "r") * (100 + percent)
    return both.where(differing <= (F.col("n_a") + F.col("n_b")) * (100 - percent)).select(*pairs.columns)


def _nearest(pairs: DataFrame) -> DataFrame:
    """For each document the pair whose bits differ least."""
    pair = F.struct("apart", "a", "b", "n_a", "n_b").alias("pair")
    each = pairs.select(F.explode(F.array("a", "b")).alias("id"), pair)
    return each.groupBy("id").agg(F.min("pair").alias("pair")).select("pair.*").distinct()


def _in_different(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose documents are in different components."""
    for side in ("a", "b"):
        own = found.select(F.col("node").alias(side), F.col("component").alias(f"in_{side}"))
        pairs = _join(pairs, own, side, "left").withColumn(f"in_{side}", F.coalesce(f"in_{side}", side))
    return pairs.where("in_a <> in_b").drop("in_a", "in_b")


def segments(documents: DataFrame, classes: DataFrame, order: GramOrder, cuts: np.ndarray, words: int) -> DataFrame:
    """id, fragment and grams of each of the given classes (id, doc_id): its n-grams in the fragments where it has any."""
    wanted = key_filter(classes, "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, words, wanted):
            out = {"id": [], "fragment": [], "grams": []}
            for own in sets:
                if not len(own):
                    continue
                digest = mix(own ^ np.uint64(len(own))).sum().view(np.int64)
                fragments = np.searchsorted(cuts, order.places(own), "right")
                for fragment in np.unique(fragments).tolist():
                    out["id"].append(digest)
                    out["fragment"].append(fragment)
                    out["grams"].append(own[fragments == fragment].view(np.int64))
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("id", pa.int64()), ("fragment", pa.int32()), ("grams", pa.list_(pa.int64()))]))

    rows = documents.where("doc_id IS NOT NULL").mapInArrow(cut, "id long, fragment int, grams array<long>")
    return rows.groupBy("id", "fragment").agg(F.first("grams").alias("grams"))  # of rows that repeat a document


def links(pairs: DataFrame, cut: DataFrame, fragments: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose overlaps, counted in each fragment and summed, reach the similarity."""
    a = cut.select(F.col("id").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    b = cut.select(F.col("id").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    each = pairs.select("a", "b", "n_a", "n_b", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))).alias("fragment"))
    partial = _join(_join(each, a, ["a", "fragment"]), b, ["b", "fragment"]).select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"))
    whole = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return whole.where(F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * percent).select("a", "b")


def _led(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of each document and the leaders of its n-grams whose sizes allow it: in each part of the ids the least by hash."""
    turn = F.xxhash64("id")
    least = F.min(F.struct(turn.alias("turn"), F.col("id"), F.col("n"), F.col("place"))).alias("least")
    leaders = members.groupBy("gram", F.pmod(turn, F.lit(LEADERS)).alias("part")).agg(least).select("gram", "least.*")
    met = members.alias("l").join(
        leaders.hint("merge").alias("r"),
        (F.col("l.gram") == F.col("r.gram")) & (F.col("l.id") != F.col("r.id")) & _sizes_allow(percent) & _places_allow(percent))
    return met.select(F.greatest("l.id", "r.id").alias("a"), F.least("l.id", "r.id").alias("b")).distinct()


def _apart(members: DataFrame, found: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of all documents that share an n-gram, are in different components, and whose sizes and bits allow it.

    Documents of an n-gram meet in blocks, each block with itself and all later ones.
    """
    placed = _join(members, found.withColumnRenamed("node", "id"), "id", "left").select(
        "gram", "id", "place", F.coalesce("component", "id").alias("component"))
    placed = stage(placed, "placed-members")
    open_grams = placed.groupBy("gram").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")).where("low < high")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rest = _join(placed, open_grams.select("gram", blocks.alias("blocks")), "gram")
    rest = stage(_join(rest, sketches, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")), "members-apart")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    own = ["id", "n", "place", "component", *_SKETCH]
    left = rest.select("gram", F.col("block").alias("i"), other.alias("j"), *own).where("j >= i").alias("l")
    right = rest.select("gram", other.alias("i"), F.col("block").alias("j"), *own).where("i <= j").alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("gram", "i", "j")]
    once = (F.col("l.i") != F.col("l.j")) | (F.col("l.id") < F.col("r.id"))
    met = left.join(right.hint("merge"), same[0] & same[1] & same[2] & once & (F.col("l.component") != F.col("r.component"))
                    & _sizes_allow(percent) & _places_allow(percent) & _bits_allow(percent))
    return met.select(F.greatest("l.id", "r.id").alias("a"), F.least("l.id", "r.id").alias("b"),
                      F.when(F.col("l.id") > F.col("r.id"), F.col("l.n")).otherwise(F.col("r.n")).alias("n_a"),
                      F.when(F.col("l.id") > F.col("r.id"), F.col("r.n")).otherwise(F.col("l.n")).alias("n_b")).distinct()


def similar_documents(documents: DataFrame, words: int = WORDS, percent: int = PERCENT, fragments: int = FRAGMENTS) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id that links reach, of each document.

    Two documents are linked if their sets of n-grams of `words` words have `percent` % of their
    union in common. A text with fewer words is one n-gram; empty, blank and null texts have none
    and are linked with nothing. A row without doc_id takes no part, its component is null. Equal
    sets are one class and compared once; repeated rows get the same result, rows of one doc_id
    with different texts follow their own text. Columns beside doc_id and text are not read; an
    empty table stays empty. Hashes of 64 bits stand for n-grams and sets.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order, in_class = gram_order(documents, words)
    signed = stage(_signed(documents, order, words, percent), "signed-documents")
    known = signed.where("doc_id IS NOT NULL AND id IS NOT NULL")
    classes = known.groupBy("id", "check", "n").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ["prefix", *_SKETCH]))
    sketches = stage(classes.select("id", "doc_id", "n", *_SKETCH), "set-sketches")
    long = stage(known.where("parities IS NOT NULL").groupBy("id").agg(F.first("parities").alias("parities")), "long-sets")
    postings = classes.select("id", "n", F.posexplode("prefix").alias("place", "gram"))
    shared = postings.groupBy("gram").agg(F.count("*").alias("members")).where("members > 1").select("gram")
    members = stage(_join(postings, shared, "gram"), "gram-members")

    total = signed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cuts = pivots(in_class, total, fragments)
    slim = sketches.select("id", "n", *_SKETCH)

    def cut(pairs: DataFrame) -> DataFrame:
        met = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        own = _join(sketches.select("id", "doc_id"), met, "id", "left_semi")
        return stage(segments(documents, own, order, cuts, words), "set-segments")

    def grown(found: DataFrame | None, pairs: DataFrame, parts: DataFrame) -> DataFrame:
        more = links(pairs, parts, fragments, percent)
        if found is not None:  # components found so far are stars already
            more = more.union(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
        return stage(components(more), "components")

    led = stage(_parities_allow(_with_sketches(_led(members, percent), slim, percent), long, percent), "led-pairs")
    nearest = stage(_nearest(led), "nearest-pairs")
    parts = cut(led)
    found = grown(None, nearest, parts)
    others = stage(_in_different(_join(led, nearest.select("a", "b"), ["a", "b"], "left_anti"), found), "other-pairs")
    if others.take(1):
        found = grown(found, others, parts)
    apart = stage(_parities_allow(_apart(members, found, slim, percent), long, percent), "pairs-apart")
    if apart.take(1):
        found = grown(found, apart, cut(apart))

    named = _join(sketches.select("id", "doc_id"), found.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("least"))
    labels = stage(_join(named.select("id", "component"), least, "component").select("id", "least"), "document-classes")
    result = _join(signed.select("doc_id", "n", "id"), labels, "id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
