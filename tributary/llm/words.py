"""Words of Arrow text columns as numpy arrays, for use inside tasks.

A block of texts is handled as one byte buffer: a table gives each byte its
class, changes of class give the words, and a polynomial hash of every word
comes from one running sum. No Python code runs per word.

Two words are taken as equal if their 64-bit hashes are equal; among n distinct
words the chance of any false match is about n**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: 1 where a byte belongs to a word: everything but blank, tab and line breaks.
NOT_SPACE = np.ones(256, np.uint8)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = 0

#: 1 for ASCII letters and digits and for all bytes of other characters.
ALPHANUMERIC = np.zeros(256, np.uint8)
ALPHANUMERIC[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) <= n:
        size = max(n + 1, 2 * BLOCK_BYTES)
        for name, base in (("_powers", _BASE), ("_inverses", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            globals()[name] = np.cumprod(table, dtype=np.uint64)
    return _powers, _inverses


@dataclass
class Texts:
    """Texts as one byte buffer; `offsets` has one entry more than there are texts."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> str:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes().decode("utf-8", "replace")


def text_blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, Texts]]:
    """(first row, texts) of blocks of at most `limit` bytes, or of one longer text. A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        part = offsets[first:last + 1]
        yield first, Texts(data[part[0]:part[-1]], part - part[0])
        first = last


@dataclass
class Words:
    """Words of a block in order: text they belong to, byte positions, hash; `starts[i]` is the first word of text i."""

    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    starts: np.ndarray


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of data[begin:end] for each span, the same wherever it stands."""
    powers, inverses = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * inverses[begin])


def words_of(texts: Texts, inside: np.ndarray = NOT_SPACE) -> Words:
    """Words are runs of bytes that `inside` marks, A-Z in lower case."""
    data = LOWER[texts.data]
    marked = np.zeros(len(data) + 1, np.uint8)
    marked[:-1] = inside[data]
    opens = marked[:-1].copy()
    opens[1:] &= 1 - marked[:-2]
    cuts = texts.offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    opens[cuts] = marked[cuts]
    begin = np.flatnonzero(opens)
    closes = marked[:-1] & (1 - marked[1:])
    cuts = cuts[cuts > 0] - 1
    closes[cuts] = marked[cuts]
    end = np.flatnonzero(closes) + 1
    starts = np.searchsorted(begin, texts.offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(starts))
    return Words(row, begin, end, span_hashes(data, begin, end), starts)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of `size` words of one text; one of the whole sequence, where there are fewer words."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out ^ hashes[i:i + n]) * np.uint64(0x9E3779B97F4A7C15 + 2 * i)
        out ^= out >> np.uint64(29)
    return mix(out)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles in ascending order."""
    return np.unique(shingles(hashes, size))
