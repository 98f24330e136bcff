"""Benchmark decontamination by latent semantic retrieval.

Items are dealt by length into blocks; the rarest words of a block's items are
its terms, weighed by document frequencies of the whole corpus. Passages of the
corpus that resemble an item, and the items themselves, are the rows of a TF-IDF
matrix whose leading right singular vectors come from a distributed randomised
SVD. Overlapping windows of every document are compared with the items by cosine
in that space. A paraphrase may replace just the rare words, so passages that
hold enough of an item's other words are candidates as well, whatever their
cosine: no passage with LCS_LIKELY of an item in order is refused. Candidates are
confirmed by the longest common subsequence of words and, where that is not
conclusive, by the words of the answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.words import ALPHANUMERIC, Words, text_blocks, words_of
from tributary.staging import stage

#: Items that share one latent space; its rank is their number and OVERSAMPLE more.
BLOCK_ITEMS = 192
OVERSAMPLE = 64
#: Items that one pass over the corpus serves; tables of this size, at most 50 MB, are sent to every task.
PASS_ITEMS = 4096
#: Rarest words of an item that are terms.
ITEM_TERMS = 10
#: Share of an item's words, rarest first, that are counted in passages; above 1 - LCS_LIKELY, so that some must be held.
SCREENED = 0.7
#: Cosine from which a passage is a row of the matrix, and from which a window is a candidate.
PASSAGE_COSINE, CANDIDATE_COSINE = 0.4, 0.4
#: Share of an item's words, in order, that proves it, and the share that does so together with the answer.
LCS_SURE, LCS_LIKELY, ANSWER_SHARE = 0.8, 0.6, 0.5


@dataclass
class Screen:
    """Counted words of a block's items, by ascending hash; items that have each, how often, and how many a passage needs."""

    terms: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    counts: np.ndarray
    needed: np.ndarray


@dataclass
class Block:
    """Items of one length class with their terms, by ascending word hash. A window is twice the longest item or more."""

    window: int
    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    terms: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    screen: Screen
    basis: np.ndarray | None = None
    latent: np.ndarray | None = None

    @property
    def least_terms(self) -> int:
        return int(min(2, (self.vectors > 0).sum(axis=1).min()))


@dataclass
class Sparse:
    """Rows of a sparse matrix: row keys, first entry of each row, and the entries' columns and values."""

    keys: np.ndarray
    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def times(self, dense: np.ndarray, chunk: int = 1 << 15) -> np.ndarray:
        out = np.empty((len(self.keys), dense.shape[1]), dense.dtype)
        first = 0
        while first < len(self.keys):
            last = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + chunk, "right")) - 1)
            a = self.starts[first]
            b = self.starts[last] if last < len(self.keys) else len(self.columns)
            part = dense[self.columns[a:b]] * self.values[a:b, None]
            out[first:last] = np.add.reduceat(part, self.starts[first:last] - a, axis=0)
            first = last
        return out


def _normed(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.add.reduceat(values * values, starts))
    return values / np.repeat(norms, np.diff(np.append(starts, len(values))))


def _windows(block: Block, row: np.ndarray, place: np.ndarray, term: np.ndarray, overlap: bool) -> Sparse | None:
    """Unit TF-IDF vectors of the windows that hold enough terms; key = text * span + number of the window."""
    step = block.window // 2 if overlap else block.window
    number = place // step
    if overlap:
        again = number > 0
        row, number, term = (np.concatenate([row, row[again]]), np.concatenate([number, number[again] - 1]),
                             np.concatenate([term, term[again]]))
    if not len(term):
        return None
    span, n = np.int64(1) << 31, len(block.terms)
    window, inverse = np.unique(row.astype(np.int64) * span + number, return_inverse=True)
    cells, counts = np.unique(inverse.astype(np.int64) * n + term, return_counts=True)
    own = cells // n
    held = np.bincount(own, minlength=len(window))
    keep = held[own] >= block.least_terms
    if not keep.any():
        return None
    own, columns, counts = own[keep], cells[keep] % n, counts[keep]
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    values = (np.log1p(counts) * block.weights[columns]).astype(np.float32)
    return Sparse(window[own[starts]], starts, columns, _normed(values, starts))


def _screen(words: list[np.ndarray], vocabulary: np.ndarray, frequency: np.ndarray) -> Screen:
    """The rarest words of each item up to SCREENED of its length.

    A passage with LCS_LIKELY of an item in order lacks at most the rest of its words, so it holds all counted ones but
    for as many.
    """
    places, items, counts, needed = [], [], [], []
    for number, own in enumerate(words):
        at, times = np.unique(np.searchsorted(vocabulary, own), return_counts=True)
        order = np.argsort(frequency[at], kind="stable")
        last = 1 + int(np.searchsorted(np.cumsum(times[order]), math.ceil(SCREENED * len(own))))
        chosen = order[:last]
        places.append(at[chosen])
        items.append(np.full(len(chosen), number))
        counts.append(times[chosen])
        least = next(m for m in range(len(own) + 1) if m / len(own) >= LCS_LIKELY)
        needed.append(times[chosen].sum() - (len(own) - least))
    place, item, count = np.concatenate(places), np.concatenate(items), np.concatenate(counts)
    order = np.lexsort((item, place))
    terms, starts = np.unique(place[order], return_index=True)
    return Screen(vocabulary[terms], np.append(starts, len(order)), item[order], count[order], np.array(needed))


def _screened(block: Block, row: np.ndarray, place: np.ndarray, term: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows, keys as in Sparse, and items whose counted words the passage around the window holds in sufficient number."""
    half, screen = block.window // 2, block.screen
    number = (place + block.window // 4) // half
    # A passage reaches over three halves, the first one begins with the text.
    parts = [(row[ok], number[ok] - back, term[ok]) for back in range(3) for ok in [number >= back]]
    early = (number == 3) & (place < 3 * half)
    parts.append((row[early], number[early] - 3, term[early]))
    row, number, term = (np.concatenate(p) for p in zip(*parts, strict=True))
    if not len(term):
        return
    window, inverse = np.unique(row.astype(np.int64) * (np.int64(1) << 31) + number, return_inverse=True)
    cells = np.unique(inverse.astype(np.int64) * len(screen.terms) + term)
    own, term = cells // len(screen.terms), cells % len(screen.terms)
    sizes = np.diff(screen.starts)[term]
    begins = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
    total = np.append(0, np.cumsum(sizes))[begins]
    n, first = len(screen.needed), 0
    while first < len(window):
        last = min(first + 4096, max(first + 1, int(np.searchsorted(total, total[first] + (1 << 21), "right")) - 1))
        part = slice(begins[first], begins[last])
        length = sizes[part]
        posted = np.repeat(screen.starts[term[part]] - np.cumsum(length) + length, length) + np.arange(length.sum())
        pair = np.repeat((own[part] - first) * n, length) + screen.items[posted]
        held = np.bincount(pair, weights=screen.counts[posted], minlength=(last - first) * n).reshape(-1, n)
        windows, items = np.nonzero(held >= screen.needed)
        yield window[first + windows], items
        first = last


class Vocabulary:
    """Finds the terms of all blocks, or the counted words, among the words of a batch."""

    def __init__(self, terms: list[np.ndarray]):
        self.hashes = np.unique(np.concatenate(terms))
        self.local = []
        for own in terms:
            local = np.full(len(self.hashes), -1, np.int64)
            local[np.searchsorted(self.hashes, own)] = np.arange(len(own))
            self.local.append(local)

    def occurrences(self, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Text, place in the text and term of all occurrences, for each block."""
        at = np.searchsorted(self.hashes, words.hash)
        at[at == len(self.hashes)] = 0
        found = np.flatnonzero(self.hashes[at] == words.hash)
        row, at = words.row[found], at[found]
        place = found - words.starts[row]
        for local in self.local:
            term = local[at]
            own = term >= 0
            yield row[own], place[own], term[own]


def common_subsequence(item: np.ndarray, passage: np.ndarray) -> int:
    """Length of the longest common subsequence, all places of the item at once in the bits of one integer."""
    masks: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for word in passage.tolist():
        mask = masks.get(word)
        if mask:
            both = row & mask
            row = (row + both | row - both) & full
    return len(item) - row.bit_count()


def _word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    out = []
    for _, block in text_blocks(pa.array(texts, pa.string())):
        words = words_of(block, ALPHANUMERIC)
        out += np.split(words.hash, words.starts[1:-1])
    return out


def _document_frequencies(documents: DataFrame, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """Documents that hold each of the words, and all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(len(hashes), np.int64), 0
        for batch in batches:
            for _, block in text_blocks(batch.column("text")):
                words = words_of(block, ALPHANUMERIC)
                at = np.searchsorted(hashes, words.hash)
                at[at == len(hashes)] = 0
                ok = hashes[at] == words.hash
                pairs = np.unique(words.row[ok].astype(np.int64) * len(hashes) + at[ok])
                found += np.bincount(pairs % len(hashes), minlength=len(hashes))
                rows += len(block)
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"word": np.append(held, -1), "n": np.append(found[held], rows)})

    counts = documents.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    counts = dict(zip(counts.word, counts.n, strict=True))
    return np.array([counts.get(i, 0) for i in range(len(hashes))], np.int64), int(counts.get(-1, 0))


def build_blocks(items: pd.DataFrame, documents: DataFrame) -> list[Block]:
    """Blocks of the items that have words; `items` has item_id, text and perhaps answer."""
    words = _word_hashes(items.text.tolist())
    answers = _word_hashes(items.answer.tolist()) if "answer" in items else [w[-max(1, len(w) // 4):] for w in words]
    order = [i for i in sorted(range(len(items)), key=lambda i: len(words[i])) if len(words[i])]
    if not order:
        return []
    vocabulary = np.unique(np.concatenate([words[i] for i in order]))
    frequency, rows = _document_frequencies(documents, vocabulary)
    idf = np.log((rows + 1) / (frequency + 1)) + 1
    classes: dict[int, list[int]] = {}
    for i in order:
        classes.setdefault(2 * max(16, 1 << int(len(words[i]) - 1).bit_length()), []).append(i)
    blocks = []
    for window, members in classes.items():
        for first in range(0, len(members), BLOCK_ITEMS):
            own = members[first:first + BLOCK_ITEMS]
            chosen = set()
            for i in own:
                at = np.searchsorted(vocabulary, np.unique(words[i]))
                chosen.update(at[np.argsort(frequency[at], kind="stable")[:ITEM_TERMS]].tolist())
            terms = np.array(sorted(chosen))
            vectors = np.zeros((len(own), len(terms)), np.float32)
            for row, i in enumerate(own):
                at = np.searchsorted(vocabulary, words[i])
                place = np.searchsorted(terms, at)
                place[place == len(terms)] = 0
                vectors[row] = np.bincount(place[terms[place] == at], minlength=len(terms))
            vectors = (np.log1p(vectors) * idf[terms]).astype(np.float32)
            vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
            blocks.append(Block(window, [items.item_id.iloc[i] for i in own], [words[i] for i in own],
                                [np.unique(answers[i]) for i in own], vocabulary[terms], idf[terms].astype(np.float32), vectors,
                                _screen([words[i] for i in own], vocabulary, frequency)))
    return blocks


def _passages(documents: DataFrame, blocks: list[Block]) -> DataFrame:
    """Rows of the blocks' matrices: passages weighed by their cosine with the nearest item."""
    vocabulary = Vocabulary([b.terms for b in blocks])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_blocks(batch.column("text")):
                words = words_of(texts, ALPHANUMERIC)
                for number, (block, found) in enumerate(zip(blocks, vocabulary.occurrences(words), strict=True)):
                    rows = _windows(block, *found, overlap=False)
                    if rows is None:
                        continue
                    near = rows.times(np.ascontiguousarray(block.vectors.T)).max(axis=1)
                    ends = np.append(rows.starts[1:], len(rows.columns))
                    kept = np.flatnonzero(near >= PASSAGE_COSINE)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(kept), number, np.int32)),
                         pa.array([rows.columns[rows.starts[i]:ends[i]].astype(np.int32).tobytes() for i in kept], pa.binary()),
                         pa.array([(rows.values[rows.starts[i]:ends[i]] * near[i]).tobytes() for i in kept], pa.binary())],
                        ["block", "terms", "weights"])

    return stage(documents.select("text").mapInArrow(build, "block int, terms binary, weights binary"), "passages")


def _products(passages: DataFrame, blocks: list[Block], right: list[np.ndarray]) -> tuple[list[np.ndarray], list[int]]:
    """A'(A X) of each block's passages A, summed over all tasks, and the number of passages."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        rows_of: dict[int, int] = {}
        for batch in batches:
            number = batch.column("block").to_numpy()
            terms, weights = batch.column("terms").to_pylist(), batch.column("weights").to_pylist()
            for block in np.unique(number).tolist():
                own = np.flatnonzero(number == block)
                columns = [np.frombuffer(terms[i], np.int32) for i in own]
                starts = np.cumsum([0, *map(len, columns)])[:-1]
                flat = np.concatenate(columns).astype(np.int64)
                values = np.concatenate([np.frombuffer(weights[i], np.float32) for i in own]).astype(float)
                product = Sparse(own, starts, flat, values).times(right[block])
                total = sums.setdefault(block, np.zeros_like(right[block]))
                rows_of[block] = rows_of.get(block, 0) + len(own)
                order = np.argsort(flat, kind="stable")
                row = np.repeat(np.arange(len(own)), np.diff(np.append(starts, len(flat))))[order]
                firsts = np.flatnonzero(np.diff(flat[order], prepend=-1))
                for a in range(0, len(firsts), 512):  # a bounded part of the product at a time
                    b = firsts[a + 512] if a + 512 < len(firsts) else len(flat)
                    part = product[row[firsts[a]:b]] * values[order[firsts[a]:b], None]
                    total[flat[order[firsts[a:a + 512]]]] += np.add.reduceat(part, firsts[a:a + 512] - firsts[a], axis=0)
        for block, total in sums.items():
            for a in range(0, len(total), 512):
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "part": pa.array([a], pa.int32()),
                                                  "rows": pa.array([rows_of[block] if a == 0 else 0], pa.int64()), "sums": [total[a:a + 512].tobytes()]})

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(s, float) for s in parts.sums], axis=0)
        return parts.head(1).assign(rows=parts.rows.sum(), sums=[total.tobytes()])

    fields = "block int, part int, rows long, sums binary"
    found = passages.mapInArrow(multiply, fields).groupBy("block", "part").applyInPandas(add, fields)
    out, counts = [np.zeros_like(r) for r in right], [0] * len(right)
    for row in found.toLocalIterator():  # terms of a block by its rank: bounded by the parameters
        width = right[row.block].shape[1]
        part = np.frombuffer(row.sums, float).reshape(-1, width)
        out[row.block][row.part:row.part + len(part)] += part
        counts[row.block] += row.rows
    return out, counts


def fit_latent(documents: DataFrame, blocks: list[Block], rounds: int = 2) -> None:
    """Set each block's basis by a randomised SVD with power iterations, and the items' places in it."""
    passages = _passages(documents, blocks)
    generator = np.random.default_rng(5)
    right = [np.linalg.qr(generator.standard_normal((len(b.terms), min(len(b.terms), len(b.ids) + OVERSAMPLE))))[0] for b in blocks]
    for number in range(rounds + 1):
        products, counts = _products(passages, blocks, right)
        for i, block in enumerate(blocks):
            vectors = block.vectors.astype(float)
            # The items weigh as much as all passages together, so that none is lost from the leading directions.
            total = products[i] + max(1.0, counts[i] / len(block.ids)) * (vectors.T @ (vectors @ right[i]))
            if number < rounds:
                right[i] = np.linalg.qr(total)[0]
            else:
                small = right[i].T @ total
                values, turn = np.linalg.eigh((small + small.T) / 2)
                kept = values > values[-1] * 1e-9
                block.basis = np.ascontiguousarray((right[i] @ turn[:, kept]).astype(np.float32))
                latent = block.vectors @ block.basis
                block.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)


def _search(column: pa.Array, blocks: list[Block], vocabulary: Vocabulary, counted: Vocabulary) -> Iterator[tuple[int, int, int, int, float, float]]:
    """(row, block, item, first word, cosine, share of the item's words found in order) of all confirmed pairs."""
    for first, texts in text_blocks(column):
        words = words_of(texts, ALPHANUMERIC)
        found = zip(blocks, vocabulary.occurrences(words), counted.occurrences(words), strict=True)
        for number, (block, terms, screened) in enumerate(found):
            best: dict[tuple[int, int], tuple[int, float, float]] = {}
            tried: set[tuple[int, int]] = set()

            def confirm(key: int, item: int, cosine: float, block=block, best=best, tried=tried) -> None:
                tried.add((key, item))
                row, index = divmod(key, 1 << 31)
                own = words.hash[words.starts[row]:words.starts[row + 1]]
                begin = max(0, index * (block.window // 2) - block.window // 4)
                passage = own[begin:begin + block.window * 3 // 2]
                target = block.words[item]
                share = common_subsequence(target, passage) / len(target)
                if share < LCS_LIKELY or share < LCS_SURE and np.isin(block.answers[item], passage).mean() < ANSWER_SHARE:
                    return
                held = best.get((row, item))
                if held is None or share > held[2]:
                    best[row, item] = begin, cosine, share

            rows = _windows(block, *terms, overlap=True)
            near = None
            if rows is not None:
                near = rows.times(block.basis) @ block.latent.T
                for window, item in zip(*np.nonzero(near >= CANDIDATE_COSINE), strict=True):
                    confirm(int(rows.keys[window]), int(item), float(near[window, item]))
            for keys, items in _screened(block, *screened):
                for key, item in zip(keys.tolist(), items.tolist(), strict=True):
                    if (key, item) not in tried:
                        at = int(np.searchsorted(rows.keys, key)) if rows is not None else 0
                        known = rows is not None and at < len(rows.keys) and rows.keys[at] == key
                        confirm(key, item, float(near[at, item]) if known else 0.0)
            for (row, item), (begin, cosine, share) in sorted(best.items()):
                yield first + row, number, item, begin, cosine, share


def _item_groups(benchmark: DataFrame) -> Iterator[pd.DataFrame]:
    columns = [c for c in ("item_id", "text", "answer") if c in benchmark.columns]
    items = benchmark.select(*columns)
    groups = max(1, -(-items.count() // PASS_ITEMS))
    for group in range(groups):
        yield items.filter(F.pmod(F.xxhash64("text"), F.lit(groups)) == group).toPandas()


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, first_word, cosine, lcs_share: every document that holds a benchmark item, with the item.

    Documents without an item give no row. Null and empty texts and items hold nothing; a null doc_id or item_id stays
    null; repeated rows and items give rows each. Without a column `answer` the last quarter of an item is its answer.
    An item of few words needs those words in order as any other. Empty tables give an empty result.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fields = "doc_id long, item_id long, first_word long, cosine double, lcs_share double"
    result = documents.sparkSession.createDataFrame([], fields)
    for items in _item_groups(benchmark):
        blocks = build_blocks(items, documents)
        if not blocks:
            continue
        fit_latent(documents, blocks)

        def search(batches: Iterator[pa.RecordBatch], blocks=blocks) -> Iterator[pa.RecordBatch]:
            vocabulary, counted = Vocabulary([b.terms for b in blocks]), Vocabulary([b.screen.terms for b in blocks])
            for batch in batches:
                found = list(_search(batch.column("text"), blocks, vocabulary, counted))
                ids = [blocks[b].ids[i] for _, b, i, *_ in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64())),
                     pa.array([None if pd.isna(i) else int(i) for i in ids], pa.int64()), pa.array([f[3] for f in found], pa.int64()),
                     pa.array([f[4] for f in found], pa.float64()), pa.array([f[5] for f in found], pa.float64())],
                    ["doc_id", "item_id", "first_word", "cosine", "lcs_share"])

        result = result.union(documents.mapInArrow(search, fields))
    return result


def remove_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, in all their columns."""
    for items in _item_groups(benchmark):
        blocks = build_blocks(items, documents)
        if not blocks:
            continue
        fit_latent(documents, blocks)

        def clean(batches: Iterator[pa.RecordBatch], blocks=blocks) -> Iterator[pa.RecordBatch]:
            vocabulary, counted = Vocabulary([b.terms for b in blocks]), Vocabulary([b.screen.terms for b in blocks])
            for batch in batches:
                at = batch.schema.get_field_index("text")
                keep = np.ones(len(batch), bool)
                keep[[f[0] for f in _search(batch.column(at), blocks, vocabulary, counted)]] = False
                yield batch.filter(pa.array(keep))

        documents = documents.mapInArrow(clean, documents.schema)
    return documents
