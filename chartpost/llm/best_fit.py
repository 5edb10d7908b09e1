"""Packing documents into training sequences by vector best-fit."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartpost.llm.tables import session, store
from chartpost.llm.tokens import slices, token_ids, with_end

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# One task packs about so many tokens and at most about so many pieces: thousands of
# sequences, of which the last few are not full.
GROUP_TOKENS = 8 << 20
GROUP_PIECES = 1 << 16


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds; attention counts the squares of its pieces' lengths."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.float64)


def piece_rows(tokenizer: str, end_id: int, most: int) -> Callable:
    """Cut each text's ids, ended by ``end_id``, into pieces of ``most`` tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(tokenizer)
        for doc_ids, texts in slices(batches):
            ids, offsets = with_end(*encoder.encode(texts), end_id)
            lengths = np.diff(offsets)
            pieces = -(-lengths // most)
            row = np.repeat(np.arange(len(texts)), pieces)
            number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * most
            length = np.minimum(lengths[row] - start, most)
            first = offsets[row] + start
            crc = [crc32(ids[a:b]) for a, b in zip(first.tolist(), (first + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids.take(pa.array(row)),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def pieces_of(documents: DataFrame, tokenizer: str, end_id: int, most: int) -> DataFrame:
    """Pieces of every document (doc_id, text); a null or empty text is its end id alone."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(piece_rows(tokenizer, end_id, most), PIECES)


def best_fit(
    lengths: np.ndarray, capacity: Capacity, rule: str, weights: tuple[float, float, float]
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; ``lengths`` come longest first.

    A piece may enter the sequences whose residual tokens, documents and attention all
    hold it.  Of these it takes the one with the least weighted norm of what would remain
    ("norm"), or the one whose residual has the greatest weighted dot-product with its
    demand ("dot"); the oldest of equals.  Where none can hold it, a new one is opened.
    """
    limits = capacity.limits()
    scale = np.asarray(weights) / limits
    order = lengths.tolist()
    least = order[-1] if order else 0
    sequence = np.empty(len(order), np.int64)
    offset = np.empty(len(order), np.int64)
    left = np.empty((1024, 3))
    name = np.empty(1024, np.int64)
    used = opened = 0
    for at, length in enumerate(order):
        need = np.array([length, 1, length * length], np.float64)
        room = left[:used]
        fits = np.flatnonzero(
            (room[:, 0] >= need[0]) & (room[:, 1] >= need[1]) & (room[:, 2] >= need[2])
        )
        if len(fits):
            if rule == "dot":
                pick = fits[np.argmax((room[fits] * scale) @ (need * scale))]
            else:
                pick = fits[np.argmin((((room[fits] - need) * scale) ** 2).sum(axis=1))]
        else:
            if used == len(left):
                left, name = np.concatenate([left, left]), np.concatenate([name, name])
            pick, used = used, used + 1
            left[pick], name[pick] = limits, opened
            opened += 1
        sequence[at] = name[pick]
        offset[at] = capacity.tokens - left[pick, 0]
        left[pick] -= need
        if left[pick, 0] < least or left[pick, 1] < 1:
            # Full: the sequences after it move up, so that the oldest stay first.
            left[pick : used - 1], name[pick : used - 1] = left[pick + 1 : used].copy(), name[pick + 1 : used].copy()
            used -= 1
    return sequence, offset


def _pack_rows(capacity: Capacity, rule: str, weights: tuple[float, float, float]) -> Callable:
    def pack_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        keys = ("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")
        rows = rows.sort_by(list(keys))
        sequence, offset = best_fit(rows["length"].to_numpy(), capacity, rule, weights)
        group = TaskContext.get().partitionId() << 32
        packed = rows.append_column("sequence_id", pa.array(sequence + group)).append_column(
            "offset", pa.array(offset)
        )
        yield from packed.to_batches()

    return pack_group


def pack(
    pieces: DataFrame,
    capacity: Capacity = Capacity(),
    rule: str = "norm",
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
) -> DataFrame:
    """Put every piece (see PIECES) into a sequence: its sequence_id and offset there.

    Pieces are dealt evenly, whatever their ids, into groups of bounded size, and each
    group is packed by itself, so copies or one frequent id fill no single task.  Within a
    group all pieces take part; the last few sequences of each are the only loss.  Offsets
    follow one another without gaps.  A piece longer than a sequence, or of a squared
    length beyond its attention, is refused.  Repeated rows are pieces of their own.
    No pieces, no rows.  ``weights`` are of tokens, documents and attention; with the
    defaults, the residual tokens alone select among the sequences all three allow.
    """
    stored = store(pieces, "pieces")
    count, tokens, longest = stored.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.max("length"), F.lit(0))
    ).first()
    if longest > capacity.tokens or longest * longest > capacity.attention or capacity.documents < 1:
        raise ValueError(f"a piece of {longest} tokens does not fit a sequence of {capacity}")
    groups = max(1, -(-tokens // GROUP_TOKENS), -(-count // GROUP_PIECES))
    schema = f"{PIECES}, sequence_id long, offset long"
    return stored.repartition(groups).mapInArrow(_pack_rows(capacity, rule, weights), schema)


def pack_documents(
    documents: DataFrame, tokenizer: str, end_id: int = 0, capacity: Capacity = Capacity()
) -> DataFrame:
    """Cut documents (doc_id, text; others ignored) into pieces and pack all of them."""
    session(documents.sparkSession)
    return pack(pieces_of(documents, tokenizer, end_id, capacity.tokens), capacity)
