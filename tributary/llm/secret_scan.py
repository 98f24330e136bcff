"""Secret scan: fixed patterns, and values in credential contexts that are costly to guess.

The cost of a value is the cheapest way to write it as words, dates, repeats,
keyboard walks and brute-force spans, in powers of ten of guesses, found by
dynamic programming over its positions. All work is per document, in batches.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # runs are maximal, so the least length can stand in the pattern
HEX = re.compile(r"[0-9a-f]{24,}")

#: A name of a credential and its value, or the password of an address.
CONTEXT = re.compile(
    r"""(?:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth)"""
    r"""["']?\s{0,3}(?:[:=]>?|\bis\b|\bwas\b)\s{0,3}["']?|\bbearer\s|://[^\s/:@]+:)([^\s"'<>,;@]+)""", re.IGNORECASE | re.ASCII)
#: A text without any of these cannot match CONTEXT; looking for plain strings is far cheaper.
HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "://")

#: Words in order of how soon a guesser tries them; more can be given.
COMMON_WORDS = (
    "password 123456 qwerty admin welcome letmein monkey dragon master login princess sunshine football iloveyou shadow "
    "secret hunter test user guest root default changeme system computer internet service server summer winter spring "
    "autumn hello love money freedom magic super batman baseball soccer michael jordan charlie daniel jessica thomas "
    "the and for you that with this have from they will would there their what about which when make like time just "
    "know people year good some could them other than then now only come over think also back after work first well "
    "even want because these give most day token key code value example sample your my is in of to").split()

_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_PLACES = {c: (x + 0.5 * y, y) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
_LEET = str.maketrans("4301$5@7", "aeolssat")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
                   r"|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)?\d\d")
_REPEAT = re.compile(r"(.{1,8}?)\1+", re.DOTALL)
#: Guesses of one more segment: a guesser has to try where segments end.
_NEXT_SEGMENT = 0.5


def _near(a: str, b: str) -> bool:
    p, q = _PLACES.get(a), _PLACES.get(b)
    return p is not None and q is not None and a != b and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _char_cost(value: str) -> float:
    sizes = ((r"[a-z]", 26), (r"[A-Z]", 26), (r"[0-9]", 10), (r"[!-/:-@\[-`{-~]", 33), (r"[^\x00-\x7f]", 100))
    return math.log10(max(10, sum(n for p, n in sizes if re.search(p, value))))


def guess_cost(value: str, ranks: dict[str, int], longest: int) -> float:
    """Log10 of the guesses for `value`; 0 for an empty one. Time and memory grow in proportion to its length."""
    n = len(value)
    low = value.lower()
    if len(low) != n:  # a character whose lower case is longer
        low = value
    plain = low.translate(_LEET)
    char = _char_cost(value)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]  # by start: (end, cost)
    for found in _DATE.finditer(value):
        ends[found.start()].append((found.end(), math.log10(365 * 120)))
    for found in _REPEAT.finditer(low):
        ends[found.start()].append((found.end(), len(found[1]) * char + math.log10(found.end() - found.start())))
    start = 0
    for i in range(1, n + 1):
        if i == n or not _near(low[i - 1], low[i]):
            if i - start >= 3:
                ends[start].append((i, math.log10(47 * 8) + 0.3 * (i - start)))
            start = i
    best, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)  # brute: the last span is a brute-force one
    for i in range(n):
        here = min(best[i], brute[i])
        extra = _NEXT_SEGMENT if i else 0.0
        brute[i + 1] = min(brute[i], best[i] + extra) + char
        for end, cost in ends[i]:
            best[end] = min(best[end], here + extra + cost)
        for end in range(i + 3, min(n, i + longest) + 1):
            rank = ranks.get(low[i:end])
            leet = 0.0
            if rank is None:
                rank, leet = ranks.get(plain[i:end]), 0.5
            if rank is not None:
                case = 0.0 if value[i:end] in (low[i:end], low[i:end].capitalize(), low[i:end].upper()) else 0.1 * (end - i)
                best[end] = min(best[end], here + extra + math.log10(rank) + leet + case)
    return min(best[n], brute[n])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guess_spans(text: str, base: list[tuple[int, int, int]], ranks: dict[str, int], longest: int,
                least: float) -> list[tuple[int, int, int]]:
    """Values in credential contexts that cost at least 10**least guesses, but for those that base spans hold as a whole.

    A value that a base span holds in part, because it goes on with other characters, is scored and given as a whole.
    """
    low = text.lower()
    if not any(hint in low for hint in HINTS):
        return []
    found = []
    for match in CONTEXT.finditer(text):
        start, value = match.start(1), match[1].rstrip(".!?)]}")
        end = start + len(value)
        held = start
        for s, _, e in base:  # in order of their starts
            if s <= held < e:
                held = e
        if held < end and guess_cost(value, ranks, longest) >= least:
            found.append((start, 3, end))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


class Scanner:
    """All spans of a text. `least`: log10 of the guesses from which a value counts as a secret."""

    def __init__(self, words: tuple[str, ...] = tuple(COMMON_WORDS), least: float = 8.0):
        self.ranks = {word: rank for rank, word in enumerate(words, 1)}
        self.longest = max(map(len, words), default=0)
        self.least = least

    def spans(self, text: str) -> tuple[list, list]:
        """(base spans, all spans), each as (start, kind, end) in order of start, then kind."""
        base = base_spans(text)
        return base, sorted(base + guess_spans(text, base, self.ranks, self.longest, self.least))

    def redact(self, text: str) -> str:
        """The text with each stretch of touching spans replaced by one mark; unchanged without spans."""
        parts, at = [], 0
        for start, _, end in self.spans(text)[1]:
            if start >= at:
                parts += [text[at:start], "[secret]"]
            at = max(at, end)
        return "".join(parts) + text[at:] if parts else text


def scan_documents(documents: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_guess of every document.

    Spans are code points, end exclusive, as kind:start:end by start, then kind. A null text is empty and has no
    spans; a null doc_id stays null. Repeated rows are scanned each. Columns beside doc_id and text are not read.
    """
    scanner = scanner or Scanner()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base, spans = scanner.spans(text or "")
                kinds = [k for _, k, _ in spans]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2),
                             hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), kinds.count(3)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()], strict=True))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long")


def redact_documents(documents: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """The documents with all secrets replaced by a mark, and n_chars, if there, set to the new length.

    No document goes. A null text stays null; n_chars of an unchanged text stays as it is.
    """
    scanner = scanner or Scanner()

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column("text").to_pylist()
            new = [text and scanner.redact(text) for text in old]
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            at = batch.schema.get_field_index("n_chars")
            if at >= 0:
                field = batch.schema.field(at)
                counts = [n if a == b else len(b) for n, a, b in zip(batch.column(at).to_pylist(), old, new, strict=True)]
                batch = batch.set_column(at, field, pa.array(counts, field.type))
            yield batch

    return documents.mapInArrow(redact, documents.schema)
