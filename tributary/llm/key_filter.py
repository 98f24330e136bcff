"""A filter of 64-bit keys that tasks hold to leave out most rows that cannot matter.

A Bloom filter of at most `MOST_BITS` bits, built by tasks and put together word by
word: a key that was put in always passes, others rarely while the bits suffice. Where
keys outgrow them it lets more pass, so whoever uses it still checks what passed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.words import mix

#: 16 MB, sent to all tasks and, as words that are not zero, to the driver.
MOST_BITS = 1 << 27
BITS_A_KEY = 16


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    mixed = mix(keys.astype(np.uint64, copy=False) + np.uint64(0x632BE59BD9B4E019))
    mask = np.uint64(bits - 1)
    return [mixed & mask, (mixed >> np.uint64(32)) & mask, mix(mixed) & mask]


class KeyFilter:
    """`holds(keys)` tells for each of an array of 64-bit keys whether it may have been put in."""

    def __init__(self, words):
        self._sent = words

    def holds(self, keys: np.ndarray) -> np.ndarray:
        words = self._sent.value
        found = np.ones(len(keys), bool)
        for place in _places(keys.view(np.uint64), 64 * len(words)):
            found &= (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def key_filter(keys: DataFrame, column: str = "key") -> KeyFilter:
    """The filter of a column of long keys; nulls are not put in."""
    keys = keys.select(F.col(column).cast("long").alias("key")).where("key IS NOT NULL")
    n = keys.count()
    bits = min(MOST_BITS, max(64, 1 << (BITS_A_KEY * n - 1).bit_length())) if n else 64

    def put_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            own = batch.column("key").to_numpy().view(np.uint64)
            for place in _places(own, bits):
                np.bitwise_or.at(words, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        slots = np.flatnonzero(words)
        for start in range(0, len(slots), 1 << 16):
            part = slots[start:start + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"slot": part, "word": words[part].view(np.int64)})

    rows = keys.mapInArrow(put_in, "slot long, word long").groupBy("slot").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[rows["slot"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    return KeyFilter(keys.sparkSession.sparkContext.broadcast(words))
