"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into at most ``bins`` bins, and the model is a table of additions per feature plus one per selected
pair of features. The tables are learned by cyclic boosting: one shallow tree at a time, on one feature (or pair) after
the other, in many small rounds, on the log loss. Scoring looks bins up and adds, for all documents of a chunk at once.

Features come from the text alone. The model is fitted on the driver on at most ``max_rows`` labelled documents (those
with the smallest hash of their id), as a classifier needs no more; everything else covers all rows.

Defined cases: a null or empty text has features 0 and is scored like any other. Without labels every score is 0.5; if
all labels are equal, it is near that label. Repeated rows are scored once each. Of several labels of a document the
worst counts. A null doc_id is held out. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_signals.llm.risk_thresholds import count_signals
from review_signals.llm.shared import is_training
from review_signals.llm.text_arrays import Texts, chunks, mix

FEATURES = (
    "log_words", "word_length", "symbols", "upper", "repeated_lines", "repeated_words", "closed_words", "digits",
    "punctuation", "wide", "distinct_words", "most_common_word", "short_words", "line_words", "upper_words", "same_ending",
)
_IS_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_IS_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_IS_PUNCTUATION = np.isin(np.arange(256), np.frombuffer(b"!\"'(),-./:;?", np.uint8))


@dataclass(frozen=True)
class Boosting:
    max_rows: int = 20_000
    bins: int = 32
    pair_bins: int = 8
    rounds: int = 60
    pair_rounds: int = 20
    pairs: int = 6
    leaves: int = 4
    rate: float = 0.2
    smoothing: float = 2.0


@dataclass
class Model:
    """Bin edges per feature, its table of additions, and per pair coarser edges and a table of additions."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, features: np.ndarray) -> np.ndarray:
        total = np.full(len(features), self.intercept)
        for column, (edges, additions) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += additions[np.searchsorted(edges, features[:, column], side="right")]
        coarse = _binned(features, self.pair_edges)
        for (a, b), additions in zip(self.pairs, self.pair_tables, strict=True):
            total += additions[coarse[:, a], coarse[:, b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def features(texts: Texts) -> np.ndarray:
    counts = count_signals(texts)
    size = len(texts)
    starts, ends = texts.words
    owner = texts.owner(starts)
    words = np.maximum(1, counts["n_words"]).astype(float)
    chars = np.maximum(1, counts["word_chars"]).astype(float)
    lines = np.maximum(1, counts["n_lines"]).astype(float)
    keys = mix(texts.hashes(starts, ends) ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    _, first, often = np.unique(keys, return_index=True, return_counts=True)
    most = np.zeros(size)
    np.maximum.at(most, owner[first], often)
    upper = np.concatenate([[0], np.cumsum(_IS_UPPER[texts.data])])
    last = texts.data[ends - 1].astype(np.int64)
    endings = np.bincount(owner * 256 + last, minlength=size * 256).reshape(size, 256)
    endings[:, 97:123] = 0
    endings[:, 128:] = 0
    return np.column_stack([
        np.log1p(counts["n_words"]),
        counts["word_chars"] / words,
        counts["n_symbols"] / chars,
        counts["n_upper"] / chars,
        counts["n_dup_lines"] / lines,
        counts["n_repeat_words"] / words,
        counts["n_closed"] / words,
        texts.count(_IS_DIGIT[texts.data]) / chars,
        texts.count(_IS_PUNCTUATION[texts.data]) / chars,
        texts.count(texts.data > 0x7F) / chars,
        np.bincount(owner[first], minlength=size) / words,
        most / words,
        np.bincount(owner[ends - starts == 1], minlength=size) / words,
        counts["n_words"] / lines,
        np.bincount(owner[upper[ends] - upper[starts] > 1], minlength=size) / words,
        endings.max(axis=1, initial=0) / words,
    ])


def _cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else np.zeros(0)


def _binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(cut, values[:, j], side="right") for j, cut in enumerate(edges)])


def _gain(gradient: np.ndarray, weight: np.ndarray, smoothing: float) -> np.ndarray:
    return gradient**2 / (weight + smoothing)


def _tree(gradient: np.ndarray, weight: np.ndarray, boosting: Boosting) -> np.ndarray:
    """Best tree of at most ``leaves`` leaves on one feature, from sums per bin; its value for each bin."""
    g, w = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    parts = [(0, len(gradient))]

    def best(low: int, high: int) -> tuple[float, int]:
        if high - low < 2:
            return 0.0, low
        at = np.arange(low + 1, high)
        gains = _gain(g[at] - g[low], w[at] - w[low], boosting.smoothing) + _gain(g[high] - g[at], w[high] - w[at], boosting.smoothing)
        top = int(gains.argmax())
        return float(gains[top] - _gain(g[high] - g[low], w[high] - w[low], boosting.smoothing)), int(at[top])

    while len(parts) < boosting.leaves:
        (gain, at), place = max((best(*part), i) for i, part in enumerate(parts))
        if gain <= 1e-9:
            break
        low, high = parts[place]
        parts[place:place + 1] = [(low, at), (at, high)]
    values = np.zeros(len(gradient))
    for low, high in parts:
        values[low:high] = (g[high] - g[low]) / (w[high] - w[low] + boosting.smoothing)
    return values


def _quarters(gradient: np.ndarray, weight: np.ndarray, smoothing: float) -> tuple[float, np.ndarray]:
    """Best pair of cuts of a two-dimensional histogram, and the values of its four quarters laid out over the bins."""
    def blocks(sums: np.ndarray) -> tuple[np.ndarray, ...]:
        grown = np.pad(sums, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
        upper_left = grown[1:-1, 1:-1]
        left, top = grown[-1:, 1:-1], grown[1:-1, -1:]
        return upper_left, left - upper_left, top - upper_left, grown[-1, -1] - left - top + upper_left

    rows, columns = gradient.shape
    if rows < 2 or columns < 2:
        return 0.0, np.zeros_like(gradient)
    g, w = blocks(gradient), blocks(weight)
    total = sum(_gain(a, b, smoothing) for a, b in zip(g, w, strict=True))
    i, j = np.unravel_index(int(total.argmax()), total.shape)
    value = [float(a[i, j] / (b[i, j] + smoothing)) for a, b in zip(g, w, strict=True)]
    laid = np.empty_like(gradient)
    laid[: i + 1, : j + 1], laid[i + 1:, : j + 1] = value[0], value[1]
    laid[: i + 1, j + 1:], laid[i + 1:, j + 1:] = value[2], value[3]
    return float(total[i, j] - _gain(gradient.sum(), weight.sum(), smoothing)), laid


def fit(rows: np.ndarray, labels: np.ndarray, boosting: Boosting = Boosting()) -> Model:  # noqa: B008 - frozen
    """Cyclic boosting: all features in turn, round by round; then the pairs that explain most of what is left."""
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.5
    width = rows.shape[1]
    edges = [_cut_points(rows[:, j], boosting.bins) for j in range(width)]
    pair_edges = [_cut_points(rows[:, j], boosting.pair_bins) for j in range(width)]
    model = Model(float(np.log(share / (1 - share))), edges, [np.zeros(len(cut) + 1) for cut in edges], [], pair_edges, [])
    if not len(labels):
        return model
    bins, coarse = _binned(rows, edges), _binned(rows, pair_edges)
    total = np.full(len(labels), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return labels - chance, chance * (1 - chance)

    for _ in range(boosting.rounds):
        for j, additions in enumerate(model.tables):
            gradient, weight = slopes()
            step = boosting.rate * _tree(np.bincount(bins[:, j], gradient, len(additions)), np.bincount(bins[:, j], weight, len(additions)), boosting)
            additions += step
            total += step[bins[:, j]]

    def histograms(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(pair_edges[a]) + 1, len(pair_edges[b]) + 1
        place = coarse[:, a] * shape[1] + coarse[:, b]
        return tuple(np.bincount(place, part, shape[0] * shape[1]).reshape(shape) for part in slopes())

    ranked = sorted(((_quarters(*histograms(a, b), boosting.smoothing)[0], a, b) for a, b in combinations(range(width), 2)), reverse=True)
    model.pairs = [(a, b) for gain, a, b in ranked[: boosting.pairs] if gain > 0]
    model.pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(boosting.pair_rounds):
        for (a, b), additions in zip(model.pairs, model.pair_tables, strict=True):
            step = boosting.rate * _quarters(*histograms(a, b), boosting.smoothing)[1]
            additions += step
            total += step[coarse[:, a], coarse[:, b]]
    return model


def learn(docs: DataFrame, labels: DataFrame, boosting: Boosting = Boosting()) -> Model:  # noqa: B008 - frozen
    """Fit on a bounded sample of the labelled documents that aren't held out."""
    chosen = labels.filter(is_training(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality")).filter(
        F.col("quality").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(boosting.max_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_rows small rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("quality"), pa.array(features(texts).tolist(), pa.list_(pa.float64()))],
                names=["doc_id", "quality", "features"])

    rows = sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("quality"), "text").mapInArrow(
        task, "doc_id long, quality long, features array<double>")
    # of rows that share an id the one with the smallest features, so that the model doesn't depend on their order
    rows = rows.groupBy("doc_id", "quality").agg(F.min("features").alias("features")).orderBy("doc_id").collect()
    table = np.array([row["features"] for row in rows], float).reshape(-1, len(FEATURES))
    return fit(table, np.array([row["quality"] for row in rows], float), boosting)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """Score and verdict of every whole text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            scores = model.score(features(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    held_out = F.coalesce(~is_training(F.col("doc_id")), F.lit(True)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, "text").mapInArrow(
        task, "doc_id long, held_out boolean, score double, predicted int")
