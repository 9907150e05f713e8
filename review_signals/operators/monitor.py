"""Questions asked of the scored output, as batch queries and, for the sliding alert, also as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_signals.config import AlertRule
from review_signals.functions.scalars import as_int, share

# fixed values: the output names fraud_count, avg_fraud_prob, total, fraud and fraud_rate, and the verdicts, which
# consumers of these tables rely on


def is_flagged() -> Column:
    return F.col("prediction") == 1.0


def totals(predictions: DataFrame) -> DataFrame:
    """Scored and flagged rows and the flag rate, 0.0 for an empty sink."""
    flags = F.coalesce(F.sum(as_int(is_flagged())), F.lit(0))
    return predictions.agg(
        F.count("*").alias("scored"), flags.alias("flagged"), share(flags, F.count("*")).alias("flag_rate")
    )


def recent(predictions: DataFrame, limit: int = 50) -> DataFrame:
    """The newest predictions, readable; equal times are ordered by review id."""
    newest = predictions.orderBy(F.desc("timestamp"), "review_id").limit(limit)
    verdict = F.when(is_flagged(), "Fraud").when(F.col("prediction") == 0.0, "Legit")
    return newest.select(
        "timestamp", "review_id", "product_id", "product_category", "star_rating",
        F.round("fraud_probability", 4).alias("fraud_probability"), verdict.alias("prediction"),
    )


def product_alerts(predictions: DataFrame, min_hits: int = 3) -> DataFrame:
    """Products with at least ``min_hits`` flags in the whole sink, most flags first."""
    grouped = predictions.where(is_flagged()).groupBy("product_id", "product_category").agg(
        F.count("prediction").alias("fraud_count"),
        F.round(F.avg("fraud_probability"), 4).alias("avg_fraud_prob"),
    )
    return grouped.where(F.col("fraud_count") >= min_hits).orderBy(F.desc("fraud_count"), "product_id",
                                                                    "product_category")


def category_rate(predictions: DataFrame) -> DataFrame:
    """Scored rows, flags and flag rate per category.

    ``total`` leaves out rows without a verdict; the rate is over all rows of the category.
    """
    hit = F.coalesce(as_int(is_flagged()), F.lit(0))
    return predictions.groupBy("product_category").agg(
        F.count("prediction").alias("total"),
        F.sum(hit).alias("fraud"),
        F.round(F.avg(hit), 4).alias("fraud_rate"),
    )


def sliding_alerts(predictions: DataFrame, rule: AlertRule = AlertRule(),
                   keys: tuple[str, ...] = ("product_id", "product_category")) -> DataFrame:
    """Keys that collect flags within a sliding window.

    On a stream the watermark bounds the state and a window is reported once it has closed; a table has
    no late rows, so every window is reported.
    """
    hits = predictions.where(is_flagged())
    if predictions.isStreaming:
        hits = hits.withWatermark("timestamp", rule.watermark)
    grouped = hits.groupBy(F.window("timestamp", rule.window, rule.slide), *keys).agg(
        F.count("*").alias("fraud_count"), F.avg("fraud_probability").alias("avg_fraud_prob")
    )
    return grouped.where(F.col("fraud_count") >= rule.min_hits).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *keys, "fraud_count", "avg_fraud_prob",
    )
