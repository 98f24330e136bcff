"""Vector bin packing of tokenised documents or examples into training sequences.

Every piece has a vector of tokens, segments (one) and loss-bearing tokens, a
sequence a limit on each. Sequences are filled one after the other: of the
pieces that still fit, the one whose vector has the largest dot product with
the room left goes in next, so that what is scarce in the sequence is matched
by what is large in the piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.tokens import UnitTokenizer
from tributary.llm.words import text_blocks
from tributary.staging import stage

#: Limits of a sequence: tokens, segments, loss-bearing tokens.
LIMITS = (2048, 256, 2048)
#: Pieces that one task places together; the padding of a last, open sequence is shared by that many.
GROUP = 8192

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(documents: DataFrame, tokenizer: str, most_tokens: int = LIMITS[0]) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of pieces of at most `most_tokens` ids, the last of a document shorter.

    A null text is empty; an empty document is its end-of-document id alone. Repeated rows give pieces each.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = UnitTokenizer(tokenizer)
        for batch in batches:
            for first, texts in text_blocks(batch.column("text")):
                ids, starts = encoder.encode(texts)
                rows = []
                for i in range(len(texts)):
                    total = int(starts[i + 1] - starts[i])
                    for at in range(0, total, most_tokens):
                        length = min(most_tokens, total - at)
                        begin = int(starts[i]) + at
                        rows.append((first + i, at, length, zlib.crc32(ids[begin:begin + length]), total))
                row, *columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row)), *(pa.array(c, pa.int64()) for c in columns)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _PIECES)


def place(vectors: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Bin of each vector by the dot-product rule; of equal products the smaller vector goes first, of equal vectors the earlier one. A vector above a limit is an error."""
    sizes = vectors / limits
    if (sizes > 1).any():
        raise ValueError("a piece exceeds a limit of its sequence")
    kinds, kind = np.unique(sizes, axis=0, return_inverse=True)
    members = np.argsort(kind, kind="stable")  # by kind, earlier vectors first
    following = np.searchsorted(kind[members], np.arange(len(kinds)))
    left = np.bincount(kind, minlength=len(kinds))
    bins = np.empty(len(sizes), np.int64)
    current, room = 0, np.ones(sizes.shape[1])
    alive = np.arange(len(kinds))
    while len(alive):
        waiting = kinds[alive]
        products = waiting @ room
        products[(waiting > room + 1e-9).any(axis=1)] = -1.0
        at = int(products.argmax())
        if products[at] < 0:
            current, room = current + 1, np.ones(sizes.shape[1])
            continue
        chosen = alive[at]
        bins[members[following[chosen]]] = current
        following[chosen] += 1
        left[chosen] -= 1
        room = room - kinds[chosen]
        if not left[chosen]:
            alive = np.delete(alive, at)
    return bins


def pack(pieces: DataFrame, limits: tuple[int, ...] = LIMITS, group: int = GROUP) -> DataFrame:
    """Pieces with `sequence_id` and `offset`, the tokens before it in its sequence.

    `pieces` has the longs of token_pieces and may have `loss_tokens`; without it all tokens bear loss, as do those of a
    null. Pieces are dealt by hash into groups of about `group`, each placed by one task. Sequences are numbered
    without meaning; inside one, pieces follow doc_id and start. An empty table stays empty.
    """
    if "loss_tokens" not in pieces.columns:
        pieces = pieces.withColumn("loss_tokens", F.col("length"))
    count = pieces.count()
    groups = max(1, -(-count // group))
    columns = [c for c in pieces.columns if c != "loss_tokens"]
    most = np.array(limits, float)

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        loss = rows.loss_tokens.fillna(rows.length)
        vectors = np.column_stack([rows.length, np.ones(len(rows)), loss]).astype(float)
        bins = np.empty(len(rows), np.int64)
        alone = (rows.length >= limits[0]).to_numpy()
        bins[~alone] = place(vectors[~alone], most)
        bins[alone] = bins[~alone].max(initial=-1) + 1 + np.arange(alone.sum())
        rows["sequence_id"] = rows.pop("_group") + groups * bins
        rows["offset"] = rows.groupby("sequence_id").length.cumsum() - rows.length
        return rows[[*columns, "sequence_id", "offset"]]

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), F.lit(groups)))
    fields = ", ".join(f"{c} long" for c in [*columns, "sequence_id", "offset"])
    return dealt.groupBy("_group").applyInPandas(fill, fields)


def pack_documents(documents: DataFrame, tokenizer: str | None = None, limits: tuple[int, ...] = LIMITS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of all pieces of all documents."""
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    return pack(stage(token_pieces(documents, tokenizer, limits[0]), "pieces"), limits)
