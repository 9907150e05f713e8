"""Whole texts of an Arrow batch as byte arrays: words, lines and 64-bit hashes of any byte range, all vectorised.

Tasks work on a few documents at a time (``CHUNK_BYTES``), so their memory does not depend on the partition. A longer
document is a chunk of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

#: The white space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < length:
        size = max(length, 2 * CHUNK_BYTES)
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, _BASE)]))
            _inverses = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, _BASE_INVERSE)]))
    return _powers, _inverses


def mix(values: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit (a finaliser for 64-bit values)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def roll(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` neighbours, in order; shorter than the input by width - 1."""
    count = max(0, len(hashes) - width + 1)
    total = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for step in range(width):
            total = total * _BASE + hashes[step:step + count]
    return mix(total)


@dataclass
class Texts:
    """Some texts, one after the other: text d is ``data[offsets[d]:offsets[d + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def first(self) -> np.ndarray:
        return self.offsets[:-1][self.offsets[1:] > self.offsets[:-1]]

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The text that holds each byte position."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def count(self, flags: np.ndarray) -> np.ndarray:
        """Flagged bytes of each text."""
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[self.offsets])

    @cached_property
    def inside(self) -> np.ndarray:
        return ~IS_SPACE[self.data]

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all words; none crosses a border between texts."""
        inside = self.inside
        before = np.concatenate([[False], inside[:-1]])[: len(inside)]
        before[self.first] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.concatenate([inside[1:], [False]])[: len(inside)]
        after[self.first[1:] - 1] = False
        return starts, np.flatnonzero(inside & ~after) + 1

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the lines that hold a word; lines end at line feeds."""
        size = len(self.data)
        begins = np.zeros(size + 1, bool)
        begins[self.first] = True
        begins[np.flatnonzero(self.data == 10) + 1] = True
        starts = np.flatnonzero(begins[:size])
        ends = np.append(starts[1:], size)[: len(starts)]
        ends = ends - (self.data[ends - 1] == 10) if len(ends) else ends
        seen = np.concatenate([[0], np.cumsum(self.inside)])
        holds = seen[ends] > seen[starts]
        return starts[holds], ends[holds]

    @cached_property
    def _prefix(self) -> np.ndarray:
        powers, _ = _power_tables(len(self.data) + 1)
        with np.errstate(over="ignore"):
            return np.concatenate([
                np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUES[self.data] * powers[: len(self.data)], dtype=np.uint64)
            ])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte range; equal content has equal hashes wherever it stands."""
        _, inverses = _power_tables(len(self.data) + 1)
        with np.errstate(over="ignore"):
            raw = (self._prefix[ends] - self._prefix[starts]) * inverses[starts]
            return mix(raw + (ends - starts).astype(np.uint64) * _BASE)

    def slices(self) -> Iterator[bytes]:
        raw = self.data.tobytes()
        for low, high in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True):
            yield raw[low:high]


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):  # noqa: ANN201 - the same kind
    """A task that hands memory back when it is done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        _hand_back()

    return run


def _hand_back() -> None:
    """Give freed memory back to the system: a Python worker outlives its tasks and should not hoard it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def as_texts(column: pa.Array) -> Texts:
    """A string or binary column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return Texts(data[offsets[0]:offsets[-1]], offsets - offsets[0])


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The rows of the batches in pieces of about ``limit`` bytes of text, each with its texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = (np.cumsum(sizes) - sizes) // limit
        bounds = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            part = batch.slice(low, high - low)
            yield part, as_texts(part.column(column))
        del batch
        _hand_back()


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """True at each of ``size`` places that a window of ``width`` places covers, given the windows' starts."""
    steps = np.zeros(size + width + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps)[:size] > 0
