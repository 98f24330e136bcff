"""Phrase collocations by dynamic itemset counting.

Documents are dealt into shards by a hash of their content, and shards are scanned in
cycles. The first cycle counts all words. After each shard every word or phrase whose
count so far reaches the threshold is noted with the step in which it did; a phrase of
k words becomes active as soon as its first and its last k - 1 words have, and is then
counted for one full cycle, whichever shard that begins with. So phrases of all lengths
are counted side by side, and scans end when no phrase has become active for a cycle.

A task knows what is active by two filters of bounded size: words and phrases that have
reached the threshold, and those that did within the last cycle. A phrase passes if both
its halves are in the first and one is in the second. A filter may let others pass for a
step, but what is counted is always the phrase's whole count in that shard; counts are
kept by shard, and of two for one shard either is right, so totals are exact. What reaches
the threshold in all has at least its share of it in some shard, so only such keys meet.

Words and phrases are 61-bit hashes of language and text with the length in the lowest
three bits (a false match among n of them has a chance of about n^2 / 2^62). A phrase's
hash is that of its first words, mixed, XOR that of its last word. Once the frequent ones
are known, one scan finds the first words of each, part by part of the documents until it
is found, and one the texts of the words of those that are in question for the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.key_filter import KeyFilter, key_filter
from tributary.llm.words import LOWER, Texts, mix, text_blocks, words_of
from tributary.operators.skew import skew_join
from tributary.staging import stage, staging_path

#: Least count, words of the longest phrase, shards of a cycle.
THRESHOLD, LONGEST, SHARDS = 10, 3, 2
#: Share of a phrase's count, in percent, from which a longer one takes its place.
ABSORBED = 50
#: Phrases of a language in the result.
TOP = 2000

UNKNOWN = "und"
_TAG_BITS = 3
_TAG = np.uint64((1 << _TAG_BITS) - 1)
#: Keys that a task gathers before it gives out what it has of them.
_GATHERED = 1 << 20
#: Eighths of the documents that are searched one after the other for the first words of phrases.
_SEARCHED = ((0, 1), (1, 2), (2, 4), (4, 8))
#: Parts of a language that are ranked apart before they are ranked together.
_RANKED_APART = 16

_SIGNS = [*range(10, 14), *b".,;:!?"]
_INSIDE = np.ones(256, np.uint8)
_INSIDE[[9, 32, *_SIGNS]] = 0
_IS_SIGN = np.zeros(256, bool)
_IS_SIGN[_SIGNS] = True


def _keys(hashes: np.ndarray, length: int) -> np.ndarray:
    return (hashes >> np.uint64(_TAG_BITS) << np.uint64(_TAG_BITS)) | np.uint64(length)


def extended(first: np.ndarray, word: np.ndarray, length: int) -> np.ndarray:
    """Key of a phrase of `length` words from that of its first length - 1 words and that of its last word."""
    return _keys(mix(first) ^ word, length)


def last_word(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Key of the last word of a phrase."""
    return _keys(key ^ mix(first), 1)


def language_key(lang: str) -> int:
    digest = int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "replace"), digest_size=8).digest(), "little")
    return digest >> _TAG_BITS << _TAG_BITS


class _Block:
    """Keys of the words of a block of texts, and which of them follows the one before it in a piece."""

    def __init__(self, texts: Texts, languages: np.ndarray):
        self.texts, self.cut = texts, words_of(texts, _INSIDE)
        self.languages = languages[self.cut.row]
        self.words = _keys(mix(self.cut.hash ^ self.languages), 1)
        piece = np.searchsorted(np.flatnonzero(_IS_SIGN[texts.data]), self.cut.begin)
        self.follows = np.zeros(len(self.words), bool)
        self.follows[1:] = (self.cut.row[1:] == self.cut.row[:-1]) & (piece[1:] == piece[:-1])

    def phrases(self, reached: KeyFilter, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For k from 2: places of phrases whose first and last k - 1 words have reached the threshold, keys of both and of the phrase."""
        places = np.flatnonzero(reached.holds(self.words))
        own = self.words[places]
        for length in range(2, longest + 1):
            if len(places) < 2:
                return
            both = np.flatnonzero((places[1:] == places[:-1] + 1) & self.follows[places[:-1] + length - 1])
            places, first, last = places[both], own[both], own[both + 1]
            own = extended(first, self.words[places + length - 1], length)
            yield places, first, last, own
            known = reached.holds(own)
            places, own = places[known], own[known]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, dict[int, str]]]:
    for batch in batches:
        named = batch.column("lang").dictionary_encode()
        names = named.dictionary.to_pylist()
        keys = np.array([language_key(name) for name in names], np.uint64)
        own = keys[named.indices.to_numpy()]
        for first, texts in text_blocks(batch.column("text")):
            yield _Block(texts, own[first:first + len(texts)]), dict(zip(keys.tolist(), names, strict=True))


def _counted(parts: list[np.ndarray]) -> pa.RecordBatch:
    keys = np.concatenate(parts)
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return pa.RecordBatch.from_pydict({"key": keys[first].view(np.int64), "n": np.diff(first, append=len(keys)).astype(np.int64)})


def _counts(documents: DataFrame, words_too: bool, reached: KeyFilter | None, recent: KeyFilter | None, lengths: set[int]) -> DataFrame:
    """key, n and tag (number of words; 0 stands for all words of a language) of active phrases of some lengths in some documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for block, _ in _blocks(batches):
            found = []
            if words_too:
                found += [block.words, block.languages]
            if lengths:
                for length, (_, first, last, own) in enumerate(block.phrases(reached, max(lengths)), 2):
                    if length in lengths:
                        found.append(own if recent is None else own[recent.holds(first) | recent.holds(last)])
            gathered += found
            size += sum(map(len, found))
            if size >= _GATHERED:
                yield _counted(gathered)
                gathered, size = [], 0
        if size:
            yield _counted(gathered)

    rows = documents.mapInArrow(count, "key long, n long")
    return rows.groupBy("key").agg(F.sum("n").alias("n")).withColumn("tag", F.col("key").bitwiseAND(F.lit(int(_TAG))).cast("int"))


class _Counted:
    """Counts of the steps so far, each in a folder with a part for each length."""

    def __init__(self, documents: DataFrame, shards: int):
        self.spark, self.shards = documents.sparkSession, shards
        self.steps: list[tuple[int, DataFrame, set[int]]] = []

    def add(self, step: int, counts: DataFrame) -> set[int]:
        """Write the counts of a step; the lengths that it counted."""
        path = staging_path(self.spark, "phrase-counts")
        counts.write.partitionBy("tag").parquet(path)
        written = self.spark.read.schema("key long, n long, tag int").parquet(path)
        tags = {r.tag for r in written.select("tag").distinct().collect()}  # at most 2 ** _TAG_BITS
        self.steps.append((step % self.shards, written, tags))
        return tags

    def totals(self, tag: int, least: int) -> DataFrame:
        """key, n and tag of the words or phrases of a length that have been counted at least so often."""
        parts = [(shard, rows.where(F.col("tag") == tag)) for shard, rows, tags in self.steps if tag in tags]
        if len(parts) == 1:
            return parts[0][1].where(F.col("n") >= least).select("key", "n", "tag")
        share = -(-least // self.shards)
        possible = key_filter(reduce(DataFrame.union, [rows.where(F.col("n") >= share).select("key") for _, rows in parts]))

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(possible.holds(batch.column("key").to_numpy())))

        rows = reduce(DataFrame.union, [rows.select("key", "n", F.lit(shard).alias("shard")) for shard, rows in parts])
        each = [F.max(F.when(F.col("shard") == s, F.col("n"))).alias(f"n{s}") for s in range(self.shards)]
        total = sum(F.coalesce(f"n{s}", F.lit(0)) for s in range(self.shards))
        counted = rows.mapInArrow(keep, "key long, n long, shard int").groupBy("key").agg(*each)
        return counted.select("key", total.alias("n"), F.lit(tag).alias("tag")).where(F.col("n") >= least)


def _frequent(documents: DataFrame, threshold: int, longest: int, shards: int) -> DataFrame:
    """key, n and tag of all words and phrases that occur at least `threshold` times, and of all languages (tag 0)."""
    shard = F.pmod(F.xxhash64("lang", "text"), F.lit(shards))
    counted = _Counted(documents, shards)
    reached: list[tuple[DataFrame, set[int]]] = []  # by step: key and tag of what reached the threshold then, and its lengths
    latest: dict[int, DataFrame] = {}  # by length: all that has
    empty = documents.sparkSession.createDataFrame([], "key long, n long, tag int")
    step = 0
    while True:
        lengths = {tag + 1 for _, tags in reached[max(0, step - shards):] for tag in tags if tag < longest}
        if step >= shards and not lengths:
            break
        before, recent = (reduce(DataFrame.union, [rows for rows, _ in some], empty.select("key", "tag")).where(F.col("tag") < longest)
                          for some in (reached, reached[max(0, step - shards):]))
        tags = counted.add(step, _counts(
            documents.where(shard == step % shards), step < shards,
            key_filter(before) if lengths else None, key_filter(recent) if lengths and step > shards else None, lengths)) - {0}
        rows, own = empty.select("key", "tag"), set()
        if tags:
            found = stage(reduce(DataFrame.union, [counted.totals(tag, threshold) for tag in sorted(tags)]), "frequent-phrases")
            rows = stage(found.select("key", "tag").join(before.select("key").hint("merge"), "key", "left_anti"), "reached")
            own = {r.tag for r in rows.select("tag").distinct().collect()}  # at most 2 ** _TAG_BITS
            latest |= {tag: found.where(F.col("tag") == tag) for tag in tags}
        reached.append((rows, own))
        step += 1
    return reduce(DataFrame.union, latest.values(), counted.totals(0, 1) if counted.steps[0][2] else empty)


def _found_first_words(documents: DataFrame, reached: KeyFilter, wanted: KeyFilter, longest: int) -> DataFrame:
    """key, first, last and lang_key of the wanted phrases in some documents, a few times each."""
    def distinct(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        own, first, language = (np.concatenate(column) for column in zip(*parts, strict=True))
        order = np.argsort(own)
        order = order[np.append(True, own[order[1:]] != own[order[:-1]])]
        own, first, language = own[order], first[order], language[order]
        return pa.RecordBatch.from_pydict({name: column.view(np.int64) for name, column in (
            ("key", own), ("first", first), ("last", last_word(own, first)), ("lang_key", language))})

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for block, _ in _blocks(batches):
            for places, first, _, own in block.phrases(reached, longest):
                held = np.flatnonzero(wanted.holds(own))
                gathered.append((own[held], first[held], block.languages[places[held]]))
                size += len(held)
            if size >= _GATHERED:
                yield distinct(gathered)
                gathered, size = [], 0
        if size:
            yield distinct(gathered)

    return documents.mapInArrow(find, "key long, first long, last long, lang_key long")


def _first_words(documents: DataFrame, frequent: DataFrame, longest: int) -> DataFrame:
    """key, lang_key and words (keys) of each frequent phrase."""
    reached = key_filter(frequent.where("tag > 0"))
    wanted = frequent.where("tag > 1").select("key")
    eighth = F.pmod(F.xxhash64("text", "lang"), F.lit(8))
    found = []
    for begin, end in _SEARCHED:
        rows = _found_first_words(documents.where((eighth >= begin) & (eighth < end)), reached, key_filter(wanted), longest)
        once = rows.groupBy("key").agg(*[F.first(c).alias(c) for c in ("first", "last", "lang_key")])
        found.append(stage(once.join(wanted.hint("merge"), "key", "left_semi"), "first-words"))
        wanted = stage(wanted.join(found[-1].select("key").hint("merge"), "key", "left_anti"), "phrases-to-find")
    once = reduce(DataFrame.union, found)
    phrases = stage(frequent.where("tag > 1").join(once.hint("merge"), "key"), "phrase-parts")
    level = phrases.where("tag = 2").select("key", "lang_key", "n", F.array("first", "last").alias("words"))
    levels = [level]
    for length in range(3, longest + 1):
        firsts = level.select(F.col("key").alias("first"), "words")
        level = skew_join(phrases.where(F.col("tag") == length), firsts, ["first"]).select(
            "key", "lang_key", "n", F.concat("words", F.array("last")).alias("words"))
        levels.append(level)
    return stage(reduce(DataFrame.union, levels), "phrase-words")


def _parts(phrases: DataFrame) -> DataFrame:
    """key, n, cut (words of the first part), l_key, r_key; with cut null, r_key is a phrase inside the longer one."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            sizes = np.diff(lists.offsets.to_numpy())
            flat, starts = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()[:-1]
            for length in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == length)
                words = [flat[starts[rows] + i] for i in range(length)]
                spans = {}  # keys of words begin .. end - 1
                for begin in range(length):
                    spans[begin, begin + 1] = words[begin]
                    for end in range(begin + 2, length + 1):
                        spans[begin, end] = extended(spans[begin, end - 1], words[end - 1], end - begin)
                cuts = [(cut, spans[0, cut], spans[cut, length]) for cut in range(1, length)]
                inside = [(None, None, own) for (begin, end), own in spans.items() if 2 <= end - begin < length]
                for cut, left, right in cuts + inside:
                    yield pa.RecordBatch.from_pydict({
                        "key": batch.column("key").take(pa.array(rows)), "n": batch.column("n").take(pa.array(rows)),
                        "cut": pa.array([cut] * len(rows), pa.int32()),
                        "l_key": pa.nulls(len(rows), pa.int64()) if left is None else pa.array(left.view(np.int64)),
                        "r_key": pa.array(right.view(np.int64))})

    return phrases.select("key", "n", "words").mapInArrow(split, "key long, n long, cut int, l_key long, r_key long")


def exact_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a^2 / (left right)) in whole numbers of 38 digits."""
    return F.expr(f"(CAST({a} AS DECIMAL(15, 0)) * CAST({a} AS DECIMAL(15, 0)) * CAST(1000000 AS DECIMAL(7, 0))) "
                  f"div (CAST({left} AS DECIMAL(19, 0)) * CAST({right} AS DECIMAL(19, 0)))")


def _scored(phrases: DataFrame, frequent: DataFrame, absorbed: int) -> DataFrame:
    """Phrases that no longer one takes the place of, with the counts and score of their lowest cut."""
    parts = stage(_parts(phrases), "phrase-cuts")
    counts = stage(frequent.select("key", "n"), "part-counts")
    cuts = parts.where("cut IS NOT NULL")
    for side in ("l", "r"):
        cuts = skew_join(cuts, counts.select(F.col("key").alias(f"{side}_key"), F.col("n").alias(side)), [f"{side}_key"])
    lowest = cuts.groupBy("key").agg(F.min(F.struct(exact_score("n", "l", "r").alias("score"), "cut", "l", "r")).alias("lowest"))
    longer = parts.where("cut IS NULL").groupBy(F.col("r_key").alias("key")).agg(F.max("n").alias("longer"))
    rows = phrases.join(lowest.hint("merge"), "key").join(longer.hint("merge"), "key", "left")
    kept = rows.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("n") * absorbed))
    return kept.select("key", "lang_key", "words", F.col("n").alias("a"), "lowest.l", "lowest.r", "lowest.score")


def _best(rows: DataFrame, by: str, order: list[Column], top: int, ranking) -> DataFrame:
    """Rows of rank 1 to `top` of each group, first ranked in parts of it, so that no task has a whole group."""
    part = F.pmod(F.xxhash64("key"), F.lit(_RANKED_APART))
    for keys in ([by, part], [by]):
        rows = rows.withColumn("rank", ranking().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return rows


def _texts(documents: DataFrame, keys: DataFrame) -> DataFrame:
    """key and text of words and languages."""
    wanted = key_filter(keys)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.uint64)
        for block, names in _blocks(batches):
            held = np.flatnonzero(wanted.holds(block.words))
            own, at = np.unique(block.words[held], return_index=True)
            fresh = ~np.isin(own, seen)
            own, at = own[fresh], held[at[fresh]]
            seen = np.union1d(seen, own)
            begin, end = block.cut.begin[at].tolist(), block.cut.end[at].tolist()
            texts = [LOWER[block.texts.data[b:e]].tobytes().decode("utf-8", "replace") for b, e in zip(begin, end, strict=True)]
            fresh = [k for k in np.unique(block.languages).tolist() if k not in seen]
            seen = np.union1d(seen, np.array(fresh, np.uint64))
            yield pa.RecordBatch.from_pydict({"key": np.append(own, np.array(fresh, np.uint64)).view(np.int64),
                                              "text": pa.array(texts + [names[k] for k in fresh], pa.string())})

    return documents.mapInArrow(find, "key long, text string").groupBy("key").agg(F.first("text").alias("text"))


def collocations(
    documents: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, absorbed: int = ABSORBED, shards: int = SHARDS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    Texts are cut at . , ; : ! ? and line breaks into pieces, pieces at blanks and tabs into
    words, A-Z in lower case. a counts all occurrences of a phrase of 2 to `longest` words within
    pieces, l and r its two parts at the cut of the lowest score floor(1000000 a^2 / (l r)), the
    first of them in a tie; n all words of the language. A phrase gives way to a longer one that
    holds it and has at least `absorbed` percent of its count. Order: score, a, phrase in bytes.

    Null texts are empty, a null lang is `und`. Empty, blank and very long texts and repeated rows
    need nothing special: every row counts. Columns beside lang and text are not read. A language
    without a phrase that occurs `threshold` times has no rows, nor has an empty table.
    """
    if not 2 <= longest <= int(_TAG):
        raise ValueError(f"phrases may have 2 to {int(_TAG)} words")
    documents = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    frequent = stage(_frequent(documents, threshold, longest, shards), "all-frequent")
    phrases = _first_words(documents, frequent, longest)
    scored = _scored(phrases, frequent, absorbed)
    order = [F.desc("score"), F.desc("a")]
    contenders = stage(_best(scored, "lang_key", order, top, F.rank).drop("rank"), "contenders")  # all ties at the end stay
    used = contenders.select("key", "lang_key", F.posexplode("words").alias("place", "word"))
    texts = stage(_texts(documents, used.select("word").union(contenders.select("lang_key")).distinct().withColumnRenamed("word", "key")), "word-texts")
    spelled = skew_join(used, texts.select(F.col("key").alias("word"), "text"), ["word"]).groupBy("key").agg(
        F.array_join(F.expr("transform(array_sort(collect_list(struct(place, text))), x -> x.text)"), " ").alias("phrase"))
    totals = frequent.where("tag = 0").select(F.col("key").alias("lang_key"), F.col("n").alias("n"))
    languages = totals.join(texts.select(F.col("key").alias("lang_key"), F.col("text").alias("lang")), "lang_key")
    named = contenders.join(spelled.hint("merge"), "key")
    ranked = _best(named, "lang_key", [*order, F.asc("phrase")], top, F.row_number)
    return skew_join(ranked, languages, ["lang_key"]).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
