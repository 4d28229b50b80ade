"""Vector bin packing of documents into token sequences.

Every example is a vector of three demands - tokens, segments, loss-bearing
tokens - and every sequence a vector of three limits.  Each input partition
packs its own documents in one pass with a bounded number of open sequences:
an example goes to the open sequence with the largest dot product between its
demand and what the sequence has left (both as shares of the limits), among
those where all three fit.  Where none fits and no more sequences may be
opened, the example is cut: its head fills the sequence with the largest dot
product up to a limit, and the rest goes on.  A sequence that ends before its
token limit (segment or loss limit reached, or the partition's end) is cut
into lengths that are powers of two, so that nothing is padded.

No rows are shuffled; a recomputed partition gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoders import worker_encoder


@dataclass(frozen=True)
class Limits:
    """Of one sequence; ``open_sequences`` bounds a task's memory."""

    tokens: int = 4096
    segments: int = 256
    loss_tokens: int = 4096
    open_sequences: int = 32


@dataclass
class Piece:
    """Tokens ``start`` to ``start + length`` of one document."""

    doc: int
    start: int
    length: int
    loss: int


def loss_in(start: int, end: int, loss_from: int) -> int:
    """Loss-bearing tokens of a range: those at ``loss_from`` and later."""
    return max(0, end - max(start, loss_from))


def largest_head(start: int, end: int, loss_from: int, tokens: int, loss: int) -> int:
    """Tokens from ``start`` on that fit both the token and the loss limit."""
    head = min(end - start, tokens)
    if loss_in(start, start + head, loss_from) > loss:
        head = max(start, loss_from) - start + loss
    return head


def power_lengths(total: int) -> list[int]:
    """``total`` as a sum of different powers of two, largest first."""
    return [1 << b for b in reversed(range(total.bit_length())) if total >> b & 1]


class Packer:
    """Open sequences of one partition.  ``add`` and ``finish`` yield closed ones, as lists of pieces."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self._scale = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=float)
        self._left = np.empty((0, 3))
        self._open: list[list[Piece]] = []

    def _put(self, at: int, piece: Piece) -> Iterator[list[Piece]]:
        self._open[at].append(piece)
        self._left[at] -= (piece.length, 1, piece.loss)
        if self._left[at].min() <= 0:
            self._left = np.delete(self._left, at, axis=0)
            yield self._open.pop(at)

    def _new(self) -> int:
        self._open.append([])
        self._left = np.vstack([self._left, self._scale])
        return len(self._open) - 1

    def add(self, doc: int, tokens: int, loss_from: int) -> Iterator[list[Piece]]:
        start, limits = 0, self.limits
        while start < tokens:
            need = np.array([tokens - start, 1, loss_in(start, tokens, loss_from)], dtype=float)
            gain = (self._left / self._scale) @ (need / self._scale)
            fits = (self._left >= need).all(axis=1)
            if fits.any():
                at = int(np.argmax(np.where(fits, gain, -1.0)))
            elif len(self._open) < limits.open_sequences or (need > self._scale).any():
                at = self._new()
            else:
                at = int(np.argmax(gain))
            room = self._left[at]
            head = largest_head(start, tokens, loss_from, int(room[0]), int(room[2]))
            piece = Piece(doc, start, head, loss_in(start, start + head, loss_from))
            yield from self._put(at, piece)
            start += head

    def finish(self) -> Iterator[list[Piece]]:
        """What is still open, poured into as few sequences as the limits allow."""
        rest = [p for pieces in self._open for p in pieces]
        self._open, self._left = [], np.empty((0, 3))
        limits, out, left = self.limits, [], self._scale.copy()
        for piece in rest:
            start, end = piece.start, piece.start + piece.length
            loss_from = end - piece.loss
            while start < end:
                head = largest_head(start, end, loss_from, int(left[0]), int(left[2]))
                loss = loss_in(start, start + head, loss_from)
                if head:
                    out.append(Piece(piece.doc, start, head, loss))
                    left -= (head, 1, loss)
                    start += head
                if left.min() <= 0 or not head:
                    yield out
                    out, left = [], self._scale.copy()
        if out:
            yield out


def without_padding(pieces: list[Piece], tokens: int) -> Iterator[list[Piece]]:
    """The sequence itself if it is full, else cut into power-of-two lengths."""
    total = sum(p.length for p in pieces)
    if total == tokens:
        yield pieces
        return
    queue = list(reversed(pieces))
    for length in power_lengths(total):
        out = []
        while length:
            p = queue.pop()
            if p.length > length:
                later = min(p.loss, p.length - length)
                queue.append(Piece(p.doc, p.start + length, p.length - length, later))
                p = Piece(p.doc, p.start, length, p.loss - later)
            out.append(p)
            length -= p.length
        yield out


def pack(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
         end_id: int | None = 2, loss_from: str | None = None, limits: Limits = Limits(),
         with_ids: bool = True) -> DataFrame:
    """Pack every document of ``docs``; one row per piece.

    Columns: the id column, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, loss_tokens, and ``ids`` (the piece's token ids) if ``with_ids``.
    ``loss_from`` names an integer column with a document's first loss-bearing
    token; without it a document's first token, which nothing precedes, bears
    none.  A loss limit of at least 1 and a segment limit of at least 1 are
    needed.

    A null text is empty; with an end id it has that one token, without one it
    gives no row.  Null ids pass through.  Repeated rows are documents of their
    own.  An empty table gives no rows.  Other columns are ignored, whatever
    their names.  Documents of any length are cut as needed; a sequence is full
    or has a power of two of tokens, so it needs no padding.
    """
    if min(limits.tokens, limits.segments, limits.loss_tokens, limits.open_sequences) < 1:
        raise ValueError("limits must be at least 1")
    start_loss = F.col(loss_from).cast("long") if loss_from else F.lit(None).cast("long")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                         F.coalesce(start_loss, F.lit(1)).alias("loss_from"))
    id_type = source.schema["id"].dataType.simpleString()
    schema = (f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, loss_tokens long" + (", ids array<int>" if with_ids else ""))
    tail = np.array([] if end_id is None else [end_id], dtype="<u4")

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = worker_encoder(tokenizer_file), Packer(limits)
        base, count = TaskContext.get().partitionId() << 33, 0
        waiting: dict[int, list] = {}  # number -> id, ids, tokens not yet given out
        rows: list[tuple] = []
        id_kind = None

        def give(sequences: Iterator[list[Piece]]) -> None:
            nonlocal count
            for pieces in sequences:
                for part in without_padding(pieces, limits.tokens):
                    offset = 0
                    for p in part:
                        doc = waiting[p.doc]
                        ids = doc[1][p.start:p.start + p.length]
                        rows.append((doc[0], p.start, p.length, zlib.crc32(ids.tobytes()), len(doc[1]),
                                     base + count, offset, p.loss, ids))
                        offset += p.length
                        doc[2] -= p.length
                        if not doc[2]:
                            del waiting[p.doc]
                    count += 1

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 9
            data = [pa.array(columns[0], id_kind)] + [pa.array(c, pa.int64()) for c in columns[1:8]]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
            if with_ids:
                data.append(pa.array([c.astype(np.int32) for c in columns[8]], pa.list_(pa.int32())))
                names.append("ids")
            rows.clear()
            return pa.RecordBatch.from_arrays(data, names)

        number = 0
        for given in batches:
            id_kind = given.schema.field("id").type
            ids, first = given.column("id").to_pylist(), given.column("loss_from").to_pylist()
            for i, codes in enumerate(encoder.encode_all(given.column("text"))):
                codes = np.concatenate((codes, tail))
                if len(codes):
                    waiting[number] = [ids[i], codes, len(codes)]
                    give(packer.add(number, len(codes), max(0, first[i])))
                    number += 1
                if len(rows) >= 4096:
                    yield batch()
        if id_kind is not None:
            give(packer.finish())
            yield batch()

    out = source.mapInArrow(pack_partition, schema)
    return out.withColumnRenamed("id", id_col)
