"""Packing of token sequences under several limits at once (vector bin packing by the dot-product heuristic).

Every task packs the documents it reads; nothing is shuffled.  A document's full-length runs are sequences by
themselves.  What remains waits in a window of pieces; the open sequence takes the piece that fits and whose demand
(tokens, segments, loss-bearing tokens, each as a share of its limit) has the largest dot product with what the sequence
has left.  When none fits, the largest piece is cut to fill the sequence.
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

from millrace.llm.tokens import WordLevelEncoder, kept_encoder
from millrace.llm.words import pieces, small_batches

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
WINDOW = 256


@dataclass
class Piece:
    """Ids ``start ..`` of a document; ``loss`` holds the number of loss-bearing ids before each of them and in all."""

    key: object
    start: int
    ids: bytes
    loss: np.ndarray

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    @property
    def losses(self) -> int:
        return int(self.loss[-1] - self.loss[0])

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.key, self.start, self.ids[: 4 * n], self.loss[: n + 1]),
            Piece(self.key, self.start + n, self.ids[4 * n :], self.loss[n:]),
        )

    def most_within(self, tokens: int, loss: int) -> int:
        """How many leading ids keep both limits."""
        return min(tokens, self.length, int(np.searchsorted(self.loss, self.loss[0] + loss, "right")) - 1)


class Packer:
    """Turns pieces into sequences, each a list of pieces within the limits on tokens, segments and loss-bearing tokens."""

    def __init__(self, tokens: int, segments: int, loss: int, window: int = WINDOW):
        self.limits = np.array([tokens, segments, loss], float)
        self.window = window
        self.held: list[Piece] = []
        self.demand = np.zeros((0, 3))

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        tokens, _, loss = self.limits.astype(int)
        while piece.length >= tokens or piece.losses > loss:
            head, piece = piece.cut(piece.most_within(tokens, loss))
            yield [head]
        if piece.length:
            self._hold(piece)
        while len(self.held) > self.window:
            yield self._sequence()

    def rest(self) -> Iterator[list[Piece]]:
        """The last sequences; one that is not full is dealt out into powers of two, which need no padding."""
        while self.held:
            sequence = self._sequence()
            used = sum(p.length for p in sequence)
            if used == self.limits[0]:
                yield sequence
                continue
            while sequence:
                room, part = 1 << used.bit_length() - 1, []
                used -= room
                while room:
                    first = sequence.pop(0)
                    if first.length > room:
                        first, left = first.cut(room)
                        sequence.insert(0, left)
                    part.append(first)
                    room -= first.length
                yield part

    def _hold(self, piece: Piece) -> None:
        self.held.append(piece)
        self.demand = np.vstack([self.demand, np.array([[piece.length, 1, piece.losses]]) / self.limits])

    def _take(self, k: int) -> Piece:
        piece, last = self.held[k], self.held.pop()
        if k < len(self.held):
            self.held[k] = last
            self.demand[k] = self.demand[-1]
        self.demand = self.demand[:-1]
        return piece

    def _sequence(self) -> list[Piece]:
        left, sequence = self.limits.copy(), []
        while self.held and left[0] > 0 and left[1] > 0:
            share = left / self.limits
            fits = (self.demand <= share + 1e-12).all(axis=1)
            if fits.any():
                piece = self._take(int(np.where(fits, self.demand @ share, -1.0).argmax()))
            else:
                largest = self._take(int(self.demand[:, 0].argmax()))
                n = largest.most_within(int(left[0]), int(left[2]))
                if not n:
                    self._hold(largest)
                    break
                piece, after = largest.cut(n)
                self._hold(after)
            sequence.append(piece)
            left -= (piece.length, 1, piece.losses)
        return sequence


def pack_documents(
    docs: DataFrame, tokenizer: str, tokens: int = 2048, segments: int = 256, loss: int | None = None, end_id: int = 1
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: one row for each piece of a document.

    A text's ids and then ``end_id`` are cut into pieces; every id lies in exactly one piece, and the pieces of a
    sequence follow one another from ``offset`` 0.  An id bears loss unless it is the first of its document.  NULL and
    empty texts have the end id alone; rows with NULL or repeated ids are packed like all others; an empty table gives
    no rows.  ``sequence_id`` holds the number of the task above the lowest 33 bits.
    """
    loss = tokens if loss is None else loss

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = kept_encoder(WordLevelEncoder, tokenizer), np.array([end_id], "<u4").tobytes()
        packer, sequence_id, rows = Packer(tokens, segments, loss), TaskContext.get().partitionId() << 33, []

        def placed(sequences: Iterator[list[Piece]]) -> None:
            nonlocal sequence_id
            for sequence in sequences:
                at = 0
                for p in sequence:
                    doc, n = p.key
                    rows.append((doc, p.start, p.length, zlib.crc32(p.ids), n, sequence_id, at))
                    at += p.length
                sequence_id += 1

        for batch in (p for b in batches for p in pieces(b)):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.of(text) + end
                n = len(ids) // 4
                before = np.arange(-1, n)  # loss-bearing ids before each id
                before[0] = 0
                placed(packer.add(Piece((doc, n), 0, ids, before)))
            yield _batch(rows)
            rows = []
        placed(packer.rest())
        yield _batch(rows)

    return small_batches(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(pack, SCHEMA)


TURNS = "conv_id bigint, turn bigint, start bigint, length bigint, loss_tokens bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


def pack_conversations(
    turns: DataFrame, tokenizer: str, tokens: int = 2048, segments: int = 16, loss: int = 1024, end_id: int = 1, trained: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """``conv_id, turn, start, length, loss_tokens, ids_crc32, sequence_id, offset``: one row for each piece of a conversation.

    ``turns`` has ``conv_id, turn, role, text``.  The ids of a conversation are those of its turns in order, each with
    ``end_id`` behind it; the ids of turns of the ``trained`` roles and their ends bear loss.  A sequence holds at most
    ``tokens`` ids, ``segments`` pieces and ``loss`` loss-bearing ids, whichever is reached first.  ``start`` counts from the
    first turn of a piece's stretch (``turn``): a conversation that one task does not hold whole, or that reaches ``tokens``
    ids, goes on as a further stretch.  NULL texts are empty, NULL roles bear no loss, rows with equal numbers go by role and
    text, rows without a conversation are one conversation each; an empty table gives no rows.
    """
    names = [c.split()[0] for c in TURNS.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = kept_encoder(WordLevelEncoder, tokenizer), np.array([end_id], "<u4").tobytes()
        packer, sequence_id, rows = Packer(tokens, segments, loss), TaskContext.get().partitionId() << 33, []
        key, held, flags = None, [], []

        def placed(sequences: Iterator[list[Piece]]) -> None:
            nonlocal sequence_id
            for sequence in sequences:
                at = 0
                for p in sequence:
                    rows.append((*p.key, p.start, p.length, p.losses, zlib.crc32(p.ids), sequence_id, at))
                    at += p.length
                sequence_id += 1

        def closed() -> None:
            nonlocal held, flags
            if held:
                before = np.concatenate([[0], np.cumsum(np.concatenate(flags))])
                placed(packer.add(Piece(key, 0, b"".join(held), before)))
            held, flags = [], []

        def batch_of() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in (p for b in batches for p in pieces(b)):
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if held and (conv is None or conv != key[0] or sum(map(len, held)) >= 4 * tokens):
                    closed()
                if not held:
                    key = (conv, turn)
                ids = encoder.of(text) + end
                held.append(ids)
                flags.append(np.full(len(ids) // 4, role in trained, np.int64))
            yield batch_of()
            rows = []
        closed()
        placed(packer.rest())
        yield batch_of()

    named = small_batches(turns).select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    order = ["conv_id", "turn", "role", "text"]
    return named.repartitionByRange("conv_id", "turn").sortWithinPartitions(*order).mapInArrow(pack, TURNS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in SCHEMA.split(", ")])
