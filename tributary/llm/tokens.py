"""Token ids of Arrow text columns by a public tokenizer with word ends.

The tokenizer never looks across white space, letters, digits and other signs,
so a text is cut into such units in bulk and only units not seen before reach
the tokenizer. Results equal encode(text, add_special_tokens=False); strings of
special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from tributary.llm.words import LOWER, NOT_SPACE, Texts, span_hashes

#: Id put behind every document.
END_OF_DOCUMENT = 1

_KIND = np.full(256, 3, np.uint8)  # 0 white space, 1 letter, 2 digit, 3 other
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
# A word with one of these bytes is given to the tokenizer whole: apostrophes join letters, and beyond the Latin
# letters U+00C0 to U+024F a character may be white space, a sign, a digit or part of a composition.
_WHOLE = np.zeros(256, bool)
_WHOLE[[39, 0xC2, *range(0xCA, 256)]] = True

# Byte-level alphabet: printable bytes stand for themselves, the others for characters from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
# The blank stays: it parts the units here, and none holds one.
_ALPHABET = dict(zip([b for b in range(256) if b not in _PRINTABLE], range(256, 512), strict=False)) | {32: 32}


def _units(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes; begin, end and whether to be taken whole of each unit; first unit of each text."""
    data = LOWER[texts.data]
    n = len(data)
    kind = _KIND[data]
    odd = _WHOLE[data]
    pair = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)) | (data[:-1] == 0xC4) & (data[1:] == 0xB0)
    odd[:-1] |= pair  # the signs for times and divided, and the letter whose lower case is two characters
    first = np.ones(n, bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    cuts = texts.offsets[1:-1]
    cuts = cuts[cuts < n]
    first[cuts] = True
    inside = NOT_SPACE[data].astype(bool)
    if odd.any():
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[cuts] = inside[cuts]
        word = np.cumsum(opens)
        whole_word = np.zeros(word[-1] + 1, bool)
        whole_word[word[odd]] = True
        whole = whole_word[word] & inside
        first = np.where(whole, opens, first)
    else:
        whole = np.zeros(n, bool)
    marks = np.flatnonzero(first | ~inside)
    ends = np.append(marks[1:], n)
    keep = inside[marks]
    begin, end = marks[keep], ends[keep]
    return data, begin, end, whole[begin], np.searchsorted(begin, texts.offsets)


class UnitTokenizer:
    """Token ids of whole blocks of texts. Remembers at most `most` units."""

    def __init__(self, path: str, most: int = 1_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.most = most
        self._forget()

    def _forget(self) -> None:
        # Known units: sorted hashes and, beside them, where their ids begin in the pool and how many there are.
        self.known = np.zeros(0, np.uint64)
        self.offset, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, hashes: np.ndarray, units: list[bytes], whole: np.ndarray) -> None:
        """Add units that are not known yet, in ascending order of their hashes."""
        plain = b" ".join(units).decode("utf-8", "replace").lower().encode().decode("latin-1").translate(_ALPHABET).split(" ")
        tokenize = self.tokenizer.model.tokenize
        ids, lengths = [], []
        for i, unit in enumerate(plain):
            if whole[i]:
                found = self.tokenizer.encode(units[i].decode("utf-8", "replace"), add_special_tokens=False).ids
            else:
                found = [t.id for t in tokenize(unit)]
            ids += found
            lengths.append(len(found))
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool) + len(ids), np.uint32)])
        self.pool[self.used:self.used + len(ids)] = ids
        lengths = np.array(lengths, np.int64)
        offsets = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.offset = np.insert(self.offset, at, offsets)
        self.length = np.insert(self.length, at, lengths)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, each text followed by the end-of-document id, and where each text starts."""
        if not len(texts.data):
            return np.full(len(texts), END_OF_DOCUMENT, np.uint32), np.arange(len(texts) + 1)
        data, begin, end, whole, starts = _units(texts)
        hashes, at, inverse = np.unique(span_hashes(data, begin, end), return_index=True, return_inverse=True)
        if len(self.known) + len(hashes) > self.most:
            self._forget()
        place = np.searchsorted(self.known, hashes)
        new = place == len(self.known)
        new[~new] = self.known[place[~new]] != hashes[~new]
        if new.any():
            first = at[new]
            raw = data.tobytes()
            units = [raw[b:e] for b, e in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
            self._learn(hashes[new], units, whole[first])
            place = np.searchsorted(self.known, hashes)
        lengths = self.length[place][inverse]
        offsets = self.offset[place][inverse]
        through = np.cumsum(lengths)
        total = int(through[-1]) if len(through) else 0
        # One id more behind each text: what lies before a unit grows by the texts that end before it.
        before = np.concatenate([[0], through])[starts] + np.arange(len(texts) + 1)
        ids = np.empty(total + len(texts), np.uint32)
        ends = before[1:] - 1
        ids[ends] = END_OF_DOCUMENT
        inside = np.ones(len(ids), bool)
        inside[ends] = False
        ids[inside] = self.pool[np.arange(total) + np.repeat(offsets - through + lengths, lengths)]
        return ids, before
