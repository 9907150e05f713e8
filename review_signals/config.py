"""Every tunable of the library, as frozen parameter objects with the default values in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LabelRules:
    """Thresholds of the three weak-supervision heuristics."""

    min_votes: int = 5
    max_helpful_ratio: float = 0.20
    burst_reviews: int = 10
    bias_min_reviews: int = 10
    bias_high_mean: float = 4.8
    bias_low_mean: float = 1.2
    # Share of positive rows a usable labelling should stay within.
    min_positive_rate: float = 0.05
    max_positive_rate: float = 0.15


@dataclass(frozen=True)
class SplitRule:
    """Hash split: the same key lands on the same side on any cluster layout."""

    seed: int = 42
    train_percent: int = 70


@dataclass(frozen=True)
class CrossRules:
    """How a rating is compared with the history of its reviewer and product."""

    unknown_mean: float = 3.0
    neutral_low: float = 3.5
    neutral_high: float = 4.5


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 100
    depth: int = 10
    seed: int = 42
    subsampling: float = 0.8
    feature_subset: str = "sqrt"
    # Rows are dealt to this many partitions by review id before training: bagging then does not depend on how the table
    # was laid out. For large tables about as many as there are cores, and the same number to repeat a result.
    partitions: int = 64
    # Score from which a review counts as flagged; None keeps the forest's own majority vote.
    threshold: float | None = None


@dataclass(frozen=True)
class AlertRule:
    """Sliding-window alert on products that collect flags."""

    window: str = "10 minutes"
    slide: str = "5 minutes"
    watermark: str = "10 minutes"
    min_hits: int = 3


@dataclass(frozen=True)
class SkewRule:
    """When a join key counts as hot, and how its rows are spread.

    A key is hot if it has at least ``hot_rows`` rows and at least 1 / ``max_hot_keys`` of the rows of all such keys,
    so no more than ``max_hot_keys`` keys can be hot. What is below takes an ordinary join, whose large partitions
    adaptive execution splits.
    """

    hot_rows: int = 1_000_000
    max_hot_keys: int = 10_000
    salts: int = 1_000


# Serving threshold on the score of class 1.
SERVING_THRESHOLD = 0.05
