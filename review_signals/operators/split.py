"""Reproducible splits and samples: pure functions of a key, so no join and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_signals.config import SplitRule
from review_signals.functions.scalars import as_int, key_bucket, share


def is_train(key: str = "customer_id", rule: SplitRule = SplitRule()) -> Column:
    return key_bucket(F.col(key), rule.seed) < rule.train_percent


def with_split(rows: DataFrame, key: str = "customer_id", rule: SplitRule = SplitRule()) -> DataFrame:
    return rows.withColumn("split", F.when(is_train(key, rule), "train").otherwise("test"))


def train_part(rows: DataFrame, key: str = "customer_id", rule: SplitRule = SplitRule()) -> DataFrame:
    return rows.where(is_train(key, rule))


def test_part(rows: DataFrame, key: str = "customer_id", rule: SplitRule = SplitRule()) -> DataFrame:
    return rows.where(~F.coalesce(is_train(key, rule), F.lit(False)))


def entity_split(rows: DataFrame, key: str = "customer_id", rule: SplitRule = SplitRule()) -> DataFrame:
    """Distinct keys with their side."""
    return with_split(rows.select(key).distinct(), key, rule)


def split_balance(labeled: DataFrame, key: str = "customer_id", rule: SplitRule = SplitRule()) -> DataFrame:
    """Rows, share of all rows and positive rate of both sides, in one pass."""
    return balance(with_split(labeled, key, rule).groupBy("split").agg(*side_sums()))


def side_sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("reviews"), F.sum(as_int(F.col("is_likely_fraud"))).alias("positives")]


def balance(counted: DataFrame) -> DataFrame:
    """Shares and rates from the sums of each side; the window runs over the two result rows only."""
    everything = F.sum("reviews").over(Window.partitionBy())
    return counted.select(
        "split",
        "reviews",
        share(F.col("reviews"), everything).alias("row_share"),
        "positives",
        share(F.col("positives"), F.col("reviews")).alias("positive_rate"),
    )


def restrict_to_keys(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in a given set, for sets that no expression describes.

    A plain semi join: Spark broadcasts a small set, and splits the partitions of hot keys of a shuffled one, as the set
    has one row per key.
    """
    return rows.join(keys.select(on).distinct(), on, "left_semi")


def row_sample(rows: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own sampling: needs no key, but the rows it picks change with the partition layout."""
    return rows.sample(fraction, seed)


def key_sample(rows: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Repeatable row sample of about ``fraction``, chosen by a hash of the key."""
    digests = 1 << 32
    return rows.where(key_bucket(F.col(key), seed, digests) < round(fraction * digests))
