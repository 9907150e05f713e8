"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The distinct vectors, as integers, are the rows of X once their mean is taken off. Each step is one job over them: every
task multiplies its rows by a vector (Xv) and multiplies the products back (Xᵀu); the driver adds up what the tasks
return, a few vectors of one number per dimension from at most ``max_tasks`` tasks. A left vector has an entry per row,
so none is ever stored: it is X times a short vector, which all steps update. Both sides are orthogonalised against all
earlier vectors (the right ones twice; the left ones again, by one more job, where much was taken off). The SVD of the
small bidiagonal matrix gives singular values and, with the right vectors, the components.

A run stops when its leading components have residuals of the size of rounding. One run finds each of several equal
singular values once only, so further runs start from random vectors orthogonal to all found so far, until one shows
that nothing as large is left, or the space is used up.

Numbers are exact as long as they can be: x is an integer, vectors are centred as (n x - S) / n, deviations are sums of
integers. Jobs read tables in the shared folder, so a lost executor costs its tasks.

Defined cases: vectors that are null, empty or hold null, NaN or infinite entries are dropped. Vectors must share their
length: the commonest length among the distinct vectors counts (the longer one, if two are as common), others are
dropped. Entries beyond 2^46 count as 2^46. Repeated vectors count once in the fit and are all returned; a null vec_id is
kept. Components whose singular value is under 1e-7 of the largest can't be told from rounding and are left out, so equal
vectors, a single one or an empty table give no components. Columns other than id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_signals.llm.shared import staged
from review_signals.llm.text_arrays import tidy

SCALE, OFFSET = 64, 1_000_000
_LARGEST = float(1 << 46)
_EXACT = 1 << 62
_ROUNDING = 1e-14
_ZERO = 1e-13
_NO_COMPONENT = 1e-7
_NOTHING_LARGER = 1e-8


@dataclass(frozen=True)
class Whiten:
    components: int = 16
    seed: int = 7
    #: Tasks of a pass; each sends some numbers per dimension to the driver.
    max_tasks: int = 2048


def _integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of all usable vectors as integers (without the offset), their rows, and their lengths."""
    lists = column.cast(pa.large_list(pa.float64()))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    values = flat.to_numpy(zero_copy_only=False)  # null becomes NaN
    sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    rows = np.flatnonzero((sizes > 0) & (bad[offsets[1:]] == bad[offsets[:-1]]))
    of_row = np.repeat(np.isin(np.arange(len(sizes)), rows), np.diff(offsets))
    scaled = np.floor(np.clip(values[of_row], -_LARGEST, _LARGEST) * SCALE)
    return scaled.astype(np.int64), rows, sizes[rows]


def pack(vector: np.ndarray) -> bytes:
    """A vector in as few bytes as its entries need; equal vectors are equal bytes."""
    low, high = int(vector.min()), int(vector.max())
    for kind in ("<i1", "<i2", "<i4"):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return vector.astype(kind).tobytes()
    return vector.astype("<i8").tobytes()


def unpack(packed: pa.Array, dims: int) -> np.ndarray:
    """Packed vectors as the rows of a matrix."""
    out = np.empty((len(packed), dims), np.int64)
    raw = [value.as_buffer() for value in packed]
    widths = np.array([len(value) // dims for value in raw], np.int64)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        joined = b"".join(raw[row] for row in rows.tolist())
        out[rows] = np.frombuffer(joined, f"<i{width}").reshape(len(rows), dims)
    return out


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct vector once, as ``dims`` and ``packed``; a vector of many rows is reduced before the shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, rows_, sizes = _integers(batch.column(0))
            vectors = np.split(values, np.cumsum(sizes)[:-1]) if len(rows_) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes.astype(np.int32)), pa.array([pack(vector) for vector in vectors], pa.binary())], names=["dims", "packed"])

    vectors = rows.select(F.col("embedding").cast("array<double>").alias("embedding"))
    return vectors.mapInArrow(tidy(task), "dims int, packed binary").distinct()


@dataclass(frozen=True)
class Centre:
    """The mean of n vectors, as exact sums per dimension (without the offset)."""

    n: int
    sums: tuple[int, ...]

    def exact(self, block: np.ndarray) -> bool:
        return not block.size or self.n * max(abs(int(block.min())), abs(int(block.max()))) + max(map(abs, self.sums)) < _EXACT

    def centred(self, block: np.ndarray) -> np.ndarray:
        """(n x - S) / n of each entry."""
        if self.exact(block):
            return (self.n * block - np.array(self.sums, np.int64)) / self.n
        return block - np.array([total / self.n for total in self.sums])

    def deviations(self, block: np.ndarray) -> pa.Array:
        """The sum of (n x - S)² of each row, exact."""
        kind = pa.decimal128(38, 0)
        if self.exact(block):
            apart = self.n * block - np.array(self.sums, np.int64)
            if not block.size or int(np.abs(apart).max()) ** 2 * block.shape[1] < _EXACT:
                return pa.array(np.einsum("ij,ij->i", apart, apart)).cast(kind)
        whole = (self.n * block.astype(object) - np.array(self.sums, object)) ** 2
        from decimal import Decimal

        return pa.array([Decimal(int(total)) for total in whole.sum(axis=1)], kind)


def _totals(fit: DataFrame, dims: int, work: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of what ``work`` makes of all blocks of rows, added up per task and then, in their order, on the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_ = np.zeros(size, np.float64), False
        for batch in batches:
            if batch.num_rows:
                total, any_ = total + work(unpack(batch.column(0), dims)), True
        if any_:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())], names=["task", "total"])

    parts = fit.select("packed").mapInArrow(task, "task long, total binary").collect()
    parts.sort(key=lambda part: part.task)
    return np.sum([np.frombuffer(part.total) for part in parts], axis=0) if parts else np.zeros(size)


def centre_of(fit: DataFrame, dims: int) -> Centre:
    """Counted and added up exactly: 32 bits at a time, in 64-bit sums per task, and in whole numbers on the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, n = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                block = unpack(batch.column(0), dims)
                low, high, n = low + (block & 0xFFFFFFFF).sum(axis=0), high + (block >> 32).sum(axis=0), n + len(block)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([low.tolist()]), pa.array([high.tolist()])], names=["n", "low", "high"])

    parts = fit.select("packed").mapInArrow(task, "n long, low array<long>, high array<long>").collect()
    sums = [sum(part.low[k] + (part.high[k] << 32) for part in parts) for k in range(dims)]
    return Centre(sum(part.n for part in parts), tuple(sums))


Multiply = Callable[[np.ndarray], tuple[np.ndarray, float]]


def _without(vector: np.ndarray, bases: list[np.ndarray]) -> np.ndarray:
    """What is left of a vector beside orthonormal ones, taken off twice."""
    if bases:
        base = np.array(bases)
        for _ in range(2):
            vector = vector - base.T @ (base @ vector)
    return vector


@dataclass
class Run:
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    ended: bool


def bidiagonalise(multiply: Multiply, start: np.ndarray, locked: list[np.ndarray], enough: Callable[[Run], bool]) -> Run:
    """Steps until ``enough`` of the values have settled, or the space is used up.

    ``multiply`` gives XᵀXq and |Xq|² of a q. X v_j = b_(j-1) u_(j-1) + a_j u_j and Xᵀ u_j = a_j v_j + b_j v_(j+1).
    """
    rights: list[np.ndarray] = []
    shorts: list[np.ndarray] = []  # u = X times these
    backs: list[np.ndarray] = []  # Xᵀu
    diagonal: list[float] = []
    above: list[float] = []
    run = Run(np.zeros(0), np.zeros((0, len(start))), np.zeros(0), True)
    right, beta = start, 0.0
    while len(rights) + len(locked) < len(start):
        short = right - beta * shorts[-1] if shorts else right
        for _ in range(2):
            back, length = multiply(short)
            if not shorts:
                break
            overlap = np.array(shorts) @ back  # with all earlier left vectors
            short, back = short - np.array(shorts).T @ overlap, back - np.array(backs).T @ overlap
            taken = float(overlap @ overlap)
            again, length = taken > 1e-6 * length, length - taken
            if not again:
                break
        alpha = float(np.sqrt(max(length, 0.0)))
        if alpha <= _ZERO * max(diagonal, default=0.0) or alpha == 0.0:
            run.ended = True
            return run
        rights.append(right)
        shorts.append(short / alpha)
        backs.append(back / alpha)
        above.append(beta)
        diagonal.append(alpha)
        rest = _without(backs[-1] - alpha * right, [*locked, *rights])
        beta = float(np.linalg.norm(rest))
        matrix = np.diag(diagonal) + np.diag(above[1:], 1)
        lefts, values, turned = np.linalg.svd(matrix)
        ended = beta <= _ZERO * values[0] or len(rights) + len(locked) == len(start)
        run = Run(values, turned @ np.array(rights), np.zeros(len(values)) if ended else beta * np.abs(lefts[-1]), ended)
        if ended or enough(run):
            return run
        right = rest / beta
    return run


def singular_triples(multiply: Multiply, dims: int, wanted: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values and their right vectors (as rows)."""
    generator = np.random.default_rng(seed)
    vectors: list[np.ndarray] = []
    values: list[float] = []
    while len(vectors) < dims:
        start = _without(multiply(generator.standard_normal(dims))[0], vectors)  # in the space of the rows
        size = float(np.linalg.norm(start))
        largest = max(values, default=0.0)
        if size == 0.0 or size <= _ZERO * largest**2:
            break
        start = _without(start / size, vectors)
        start /= np.linalg.norm(start)
        missing = wanted - len(values)
        floor = sorted(values, reverse=True)[wanted - 1] * (1 + 1e-9) if missing <= 0 else 0.0

        def new(run: Run, missing: int = missing, floor: float = floor) -> int:
            return min(missing, len(run.values)) if missing > 0 else int((run.values > floor).sum())

        def enough(run: Run, largest: float = largest, missing: int = missing) -> bool:
            if len(run.values) < missing:
                return False
            found, top = new(run), max(largest, float(run.values[0]))
            return bool((run.residuals[:found] <= _ROUNDING * top).all() and run.residuals[0] <= _NOTHING_LARGER * top)

        run = bidiagonalise(multiply, start, vectors, enough)
        found = new(run)
        vectors += list(run.vectors[:found])
        values += run.values[:found].tolist()
        if not found or (run.ended and len(run.values) + len(vectors) - found == dims):
            break
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    order = order[np.array(values)[order] > _NO_COMPONENT * max(values, default=0.0)] if len(order) else order
    return np.array(values)[order], np.array(vectors).reshape(-1, dims)[order]


@dataclass(frozen=True)
class Whitening:
    """What whitens vectors: their centre, unit components (as rows) with their variances, and how well that works."""

    centre: Centre
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def directions(self) -> np.ndarray:
        """A column per component; centred rows times these are white."""
        return (self.components / np.sqrt(self.variances)[:, None]).T


def learn(rows: DataFrame, whiten: Whiten = Whiten()) -> Whitening | None:  # noqa: B008 - frozen
    """Fit on the distinct vectors of ``rows`` (embedding); None if there is no component."""
    vectors = staged(fit_list(rows), "distinct-vectors")
    lengths = vectors.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return None
    dims = lengths.dims
    fit = vectors.filter(F.col("dims") == dims)
    if fit.rdd.getNumPartitions() > whiten.max_tasks:
        fit = fit.coalesce(whiten.max_tasks)
    centre = centre_of(fit, dims)

    def multiply(vector: np.ndarray) -> tuple[np.ndarray, float]:
        def work(block: np.ndarray) -> np.ndarray:
            rows_ = centre.centred(block)
            left = rows_ @ vector
            return np.append(rows_.T @ left, left @ left)

        out = _totals(fit, dims, work, dims + 1)
        return out[:-1], float(out[-1])

    values, components = singular_triples(multiply, dims, whiten.components, whiten.seed)
    if not len(values):
        return None
    components = components * np.sign(components[np.arange(len(components)), np.abs(components).argmax(axis=1)])[:, None]
    variances = values**2 / centre.n
    count = len(values)
    directions = (components / np.sqrt(variances)[:, None]).T

    def spread(block: np.ndarray) -> np.ndarray:
        rows_ = centre.centred(block)
        white = rows_ @ directions
        return np.append((white.T @ white).ravel(), (rows_**2).sum())

    totals = _totals(fit, dims, spread, count * count + 1) / centre.n
    error = float(np.abs(totals[:-1].reshape(count, count) - np.eye(count)).max())
    return Whitening(centre, components, variances, variances / totals[-1], error)


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """Per usable vector its vec_id, ``deviation`` (exact, in decimals) and ``whitened``, a number per component."""
    centre, directions, dims = model.centre, model.directions, model.components.shape[1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, kept, sizes = _integers(batch.column("embedding"))
            fits = sizes == dims
            block, kept = values[np.repeat(fits, sizes)].reshape(-1, dims), kept[fits]
            white = centre.centred(block) @ directions
            offsets = pa.array(np.arange(len(kept) + 1, dtype=np.int32) * white.shape[1])
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(kept)), centre.deviations(block),
                pa.ListArray.from_arrays(offsets, pa.array(white.ravel())),
            ], names=["vec_id", "deviation", "whitened"])

    own = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return own.mapInArrow(tidy(task), "vec_id long, deviation decimal(38,0), whitened array<double>")


def digest(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """A row per vector and component. A deviation that is no 64-bit number shows as null."""
    if model is None:
        none = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], none)
    long_ = F.col("deviation").try_cast("long").alias("deviation")
    flat = whiten(rows, model).select("vec_id", long_, F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*map(F.lit, model.explained.tolist()))
    return flat.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.centre.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
