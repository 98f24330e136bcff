"""Similarity of token-sorted names on a scale of 0 to 100.

score = 100 × 2·LCS / (length + length), LCS being the longest common
subsequence.  Cutoffs are compared in integers: 200·LCS >= cutoff·(lengths).
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lcs(left: str, right: str) -> int:
    """Bit-parallel LCS (Crochemore et al. 2001, Hyyrö 2004)."""
    if not left or not right:
        return 0
    places: dict[str, int] = {}
    for index, char in enumerate(left):
        places[char] = places.get(char, 0) | (1 << index)
    full = (1 << len(left)) - 1
    free = full
    for char in right:
        hit = free & places.get(char, 0)
        if hit:
            free = ((free + hit) | (free - hit)) & full
    return len(left) - free.bit_count()


def _code_points(texts: list[str], lengths: np.ndarray, width: int, filling: int) -> np.ndarray:
    """Code points of texts, a row each, filled up with a number that is none."""
    encoded = "".join(text.ljust(width) for text in texts).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(encoded, np.uint32).reshape(len(texts), width)
    return np.where(np.arange(width) < lengths[:, None], points, np.uint32(filling))


def _lcs_of_short(left: list[str], right: list[str]) -> np.ndarray:
    """The same for many pairs at once; left texts have at most 64 characters."""
    lengths, others = (np.array([len(text) for text in texts]) for texts in (left, right))
    width = int(others.max(initial=0))
    bits = next(n for n in (8, 16, 32, 64) if n >= lengths.max(initial=0))
    kind = np.dtype(f"uint{bits}")
    a = _code_points(left, lengths, bits, 0xFFFFFFFE)
    b = _code_points(right, others, width, 0xFFFFFFFF)

    def packed(same: np.ndarray) -> np.ndarray:
        return np.packbits(same, axis=1, bitorder="little").view(kind)[:, 0]

    free = np.full(len(left), ~kind.type(0))
    for place in range(width):
        hit = packed(a == b[:, place:place + 1]) & free
        free = (free + hit) | (free - hit)
    return bits - np.bitwise_count(free | packed(a == 0xFFFFFFFE)).astype(np.int32)


_PAIRS_AT_ONCE = 1 << 13


def _lcs_of(left: Iterable[str], right: Iterable[str]) -> np.ndarray:
    pairs = [(b, a) if len(a) > len(b) else (a, b) for a, b in zip(left, right, strict=True)]  # the shorter one first
    out = np.zeros(len(pairs), np.int32)
    short = np.array([len(a) <= 64 for a, _ in pairs], bool)
    for i in np.flatnonzero(~short):
        out[i] = _lcs(*pairs[i])
    # by length, so that texts of a group need little filling
    order = sorted(np.flatnonzero(short).tolist(), key=lambda i: ((len(pairs[i][0]) - 1) // 8, len(pairs[i][1])))
    for start in range(0, len(order), _PAIRS_AT_ONCE):
        part = order[start:start + _PAIRS_AT_ONCE]
        out[part] = _lcs_of_short([pairs[i][0] for i in part], [pairs[i][1] for i in part])
    return out


@F.pandas_udf(T.IntegerType())
def _lcs_length(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(_lcs_of(left, right))


# a filter on the result would otherwise be pushed below it as a second evaluation
lcs_length = _lcs_length.asNondeterministic()


#: Larger than any code point.
_FILLING = 0xFFFFFFFE
#: Masks that a block of left names may have, 8 bytes each.
_MASKS = 1 << 22


class NearestNames:
    """The nearest right names of each left name of a block; right names of one length come in order.

    `sets` are the words of the bit sets of characters, a row a name. Two names cannot have
    more characters in common than the bits both have and those that have no bit of their
    own, so a left name that has found as many as are wanted only takes the LCS of names
    that may come before its last one; of equal names the earlier one counts.
    """

    def __init__(self, names: list[str], sets: np.ndarray, length: int, cutoff: int, limit: int):
        self._names, self._sets, self._length, self._limit = names, sets, length, limit
        lengths = np.array([len(name) for name in names], np.int32)
        self._bitless = lengths - np.bitwise_count(sets).sum(axis=1, dtype=np.int32)
        self._least = -(-cutoff * (lengths + length) // 200)
        self._seen = 0
        self._best = [np.zeros(0, np.int64) for _ in range(3)]  # left name, right name, LCS
        self._short = np.flatnonzero(lengths <= 64)
        texts = [names[i] for i in self._short]
        points = _code_points(texts, lengths[self._short], int(lengths[self._short].max(initial=0)), _FILLING)
        self._alphabet = np.unique(np.append(points, _FILLING))  # the filling comes last
        if len(self._alphabet) * len(names) > _MASKS:
            self._short = self._short[:0]
        self._masks = np.zeros((len(names), len(self._alphabet)), np.uint64)[:len(names) if len(self._short) else 0]
        for place in range(points.shape[1] if len(self._short) else 0):
            self._masks[self._short, self._letters(points[:, place])] |= np.uint64(1 << place)
        self._masks[:, -1] = 0
        self._is_short = np.zeros(len(names), bool)
        self._is_short[self._short] = True

    def _letters(self, points: np.ndarray) -> np.ndarray:
        """Numbers of characters in the alphabet of the left names, its last one for others."""
        at = np.searchsorted(self._alphabet, points)
        at[at == len(self._alphabet)] = 0
        return np.where(self._alphabet[at] == points, at, len(self._alphabet) - 1)

    def _lcs(self, left: np.ndarray, right: np.ndarray, names: list[str], chars: np.ndarray) -> np.ndarray:
        out = np.zeros(len(left), np.int32)
        short = self._is_short[left]
        at, rows = left[short] * len(self._alphabet), right[short]
        masks, free = self._masks.ravel(), np.full(len(at), ~np.uint64(0))
        for place in range(self._length if len(at) else 0):
            hit = masks[at + chars[place, rows]] & free
            free = (free + hit) | (free - hit)
        out[short] = np.bitwise_count(~free)  # bits beyond a name's end stay set
        if not short.all():
            long = np.flatnonzero(~short)
            out[long] = _lcs_of([self._names[i] for i in left[long]], [names[i] for i in right[long]])
        return out

    def meet(self, names: list[str], sets: np.ndarray) -> None:
        bitless = self._length - np.bitwise_count(sets).sum(axis=1, dtype=np.int32)
        lengths = np.full(len(names), self._length)
        chars = self._letters(_code_points(names, lengths, self._length, _FILLING)).T.copy() if len(self._short) else None
        start, size = 0, 32
        while start < len(names):
            part = slice(start, start + size)
            common = np.bitwise_count(self._sets[:, :1] & sets[part, 0])
            for word in range(1, sets.shape[1]):
                common += np.bitwise_count(self._sets[:, word:word + 1] & sets[part, word])
            left, right = np.nonzero(common + np.minimum(self._bitless[:, None], bitless[part]) >= self._least[:, None])
            for first in range(0, len(left), _PAIRS_AT_ONCE):
                some = slice(first, first + _PAIRS_AT_ONCE)
                l, r = left[some], right[some] + start
                lcs = self._lcs(l, r, names, chars)
                near = lcs >= self._least[l]
                if near.any():
                    self._add(l[near], r[near] + self._seen, lcs[near])
            start, size = start + size, min(2 * size, 256)
        self._seen += len(names)

    def _add(self, *more: np.ndarray) -> None:
        left, right, lcs = (np.concatenate(both) for both in zip(self._best, more, strict=True))
        order = np.lexsort((right, -lcs, left))
        left, right, lcs = left[order], right[order], lcs[order]
        rank = np.arange(len(left)) - np.searchsorted(left, left)
        self._best = [column[rank < self._limit] for column in (left, right, lcs)]
        last = rank == self._limit - 1
        self._least[left[last]] = lcs[last] + 1

    def best(self) -> list[np.ndarray]:
        """Left and right names, numbered as they came, and their LCS; at most `limit` of a left name."""
        return self._best


def score(lcs: Column, total_length: Column) -> Column:
    """100 for two empty texts."""
    distance = total_length - 2 * lcs
    share = F.when(total_length == 0, F.lit(0.0)).otherwise(distance / total_length)
    return (F.lit(1.0) - share) * 100


def reaches(lcs: Column, total_length: Column, cutoff: int) -> Column:
    return 200 * lcs >= cutoff * total_length
