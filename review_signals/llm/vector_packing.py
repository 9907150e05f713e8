"""Packing of tokenised documents into training sequences under several limits at once.

A sequence has room for ``max_tokens`` tokens, ``max_segments`` pieces and ``max_loss`` loss-bearing tokens: those behind a
document's prompt, whose length in tokens an optional column gives; without a prompt all but the first token, which
nothing predicts. Each task fills one sequence after the other from a pool of waiting
pieces by the dot-product heuristic of vector bin packing: of the pieces that fit, the one whose demand has the largest
dot product with the room that is left, each limit in its own units. When nothing fits whole, the longest piece is cut to
what all limits leave, unless that is under ``min_cut`` tokens. The last pieces of a task go into sequences whose sizes are powers of two,
so that nothing is padded there.

Documents stay in the task that reads them: nothing is shuffled, a task holds ``pool`` pieces of at most ``max_tokens``
tokens, and a sequence id is the task's number and a counter.

Defined cases: a null or empty text has one token, the end id. A null doc_id is kept. Repeated rows are packed once
each. A document of any length is cut into pieces that the limits allow. A null or negative prompt length is 0, one
beyond the document leaves it without loss-bearing tokens. An empty table gives no pieces. Columns other
than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_signals.llm.text_arrays import chunks
from review_signals.llm.tokens import TOKENISED_BYTES, encoder

COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")
SCHEMA = ", ".join(f"{name} long" for name in COLUMNS)
_ARROW = pa.schema([(name, pa.int64()) for name in COLUMNS])
_ROWS_OUT = 20_000


@dataclass(frozen=True)
class Limits:
    max_tokens: int = 4096
    max_segments: int = 64
    max_loss: int = 4096
    pool: int = 1024
    min_cut: int = 64
    end_id: int = 2

    def __post_init__(self) -> None:
        if min(self.max_tokens, self.max_segments, self.max_loss, self.pool) < 1:
            raise ValueError("limits must be positive")


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int
    #: The document's first tokens, which bear no loss.
    prompt: int = 1

    @property
    def loss(self) -> int:
        return len(self.ids) - self._free

    @property
    def _free(self) -> int:
        return min(max(self.prompt - self.start, 0), len(self.ids))

    def fitting(self, tokens: int, loss: int) -> int:
        """How many of its first tokens fit into that room."""
        return min(len(self.ids), tokens, self._free + loss)

    def cut(self, size: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:size], self.doc_tokens, self.prompt),
            Piece(self.doc_id, self.start + size, self.ids[size:], self.doc_tokens, self.prompt),
        )


@dataclass
class Packer:
    """The sequences of one task. ``emit`` gets each finished sequence as a list of pieces."""

    limits: Limits
    emit: Callable[[list[Piece]], None]
    _waiting: list[Piece] = field(default_factory=list)

    def add(self, doc_id: int | None, ids: np.ndarray, prompt: int = 0) -> None:
        rest = Piece(doc_id, 0, ids, len(ids), max(prompt, 1))
        while (size := rest.fitting(self.limits.max_tokens, self.limits.max_loss)) < len(rest.ids):
            part, rest = rest.cut(size)
            if size == self.limits.max_tokens:
                self.emit([part])
            else:  # full of loss-bearing tokens, with room for prompts of others
                self._wait(part)
        self._wait(rest)

    def _wait(self, piece: Piece) -> None:
        self._waiting.append(piece)
        if len(self._waiting) >= self.limits.pool:
            self._fill(keep=self.limits.pool // 2)

    def finish(self) -> None:
        self._fill(keep=0)

    def _fill(self, keep: int) -> None:
        """Close sequences until at most ``keep`` pieces wait."""
        limits, pieces = self.limits, self._waiting
        demand = np.array([(len(p.ids), 1, p.loss) for p in pieces], np.int64).reshape(-1, 3)
        scale = np.array([limits.max_tokens, limits.max_segments, limits.max_loss], float)
        weighted = demand / (scale * scale)
        alive = np.ones(len(pieces), bool)
        left = int(alive.sum())
        while left > keep:
            room = np.array([limits.max_tokens, limits.max_segments, limits.max_loss], np.int64)
            chosen: list[Piece] = []
            while left:
                score = np.where(alive & (demand <= room).all(axis=1), weighted @ room, -1.0)
                best = int(score.argmax())
                if score[best] < 0:
                    break
                chosen.append(pieces[best])
                room -= demand[best]
                alive[best] = False
                left -= 1
            gap = int(room[0])
            if left and room[1] > 0 and gap >= limits.min_cut:
                best = int(np.where(alive, demand[:, 0], -1).argmax())
                size = pieces[best].fitting(gap, int(room[2]))
                if size >= limits.min_cut:
                    head, tail = pieces[best].cut(size)
                    chosen.append(head)
                    pieces[best] = tail
                    demand[best] = len(tail.ids), 1, tail.loss
                    weighted[best] = demand[best] / (scale * scale)
                    gap -= size
            if keep or left or not gap:
                self.emit(chosen)
            else:
                self._powers(chosen)
        self._waiting = [piece for piece, held in zip(pieces, alive.tolist(), strict=True) if held]

    def _powers(self, pieces: list[Piece]) -> None:
        """The last sequence as sequences whose sizes are powers of two, the largest first."""
        waiting = pieces[::-1]
        total = sum(len(piece.ids) for piece in pieces)
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            chosen = []
            while room:
                piece = waiting.pop()
                if len(piece.ids) > room:
                    piece, tail = piece.cut(room)
                    waiting.append(tail)
                chosen.append(piece)
                room -= len(piece.ids)
            self.emit(chosen)


def pack(docs: DataFrame, tokenizer_path: str, limits: Limits = Limits(), prompt: str | None = None) -> DataFrame:  # noqa: B008 - frozen
    """One row per piece: its document and place there, its sequence and place there, and a digest of its ids. ``prompt`` names
    a column with the number of a document's first tokens that bear no loss."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []

        def emit(pieces: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for piece in pieces:
                rows.append((piece.doc_id, piece.start, len(piece.ids), zlib.crc32(piece.ids.tobytes()), piece.doc_tokens,
                             sequence, offset, piece.loss))
                offset += len(piece.ids)
            sequence += 1

        def ready() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [()] * len(COLUMNS)
            batch = pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], schema=_ARROW)
            rows.clear()
            return batch

        packer, words, end = Packer(limits, emit), encoder(tokenizer_path), np.array([limits.end_id], np.uint32)
        for part, texts in chunks(batches, "text", TOKENISED_BYTES):
            columns = part.column("doc_id").to_pylist(), part.column("prompt").to_pylist()
            for doc_id, length, ids in zip(*columns, words.encode(texts), strict=True):
                packer.add(doc_id, np.concatenate([ids, end]).astype("<u4"), length)
            if len(rows) >= _ROWS_OUT:
                yield ready()
        packer.finish()
        yield ready()

    length = F.coalesce(F.col(prompt).cast("long"), F.lit(0)) if prompt else F.lit(0).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), length.alias("prompt"), "text").mapInArrow(task, SCHEMA)
