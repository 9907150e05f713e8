"""Areas under the ROC and the precision-recall curve, for every group of scored rows at once.

A curve has a point for every distinct score of a group, and its steps need running totals from the highest score on.
Groups can be of any size, so no group is ever sorted in one task: the points are dealt to slices by range of group and
score, running totals are formed within each slice, and what a group has in earlier slices is carried in, from one row
per group and slice. A slice holds about one n-th of all points, whichever group they belong to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_signals.sources.tables import stage


def curve_points(scored: DataFrame, *keys: str) -> DataFrame:
    """Positives and rows of every distinct score of a group; rows without a score have no place on a curve."""
    known = scored.where(F.col("fraud_probability").isNotNull())
    hits = F.sum(F.when(F.col("label") == 1.0, 1).otherwise(0)).alias("hits")
    return known.groupBy(*keys, F.col("fraud_probability").alias("score")).agg(hits, F.count(F.lit(1)).alias("n"))


def sliced(points: DataFrame, slices: int, *keys: str) -> DataFrame:
    """The points, written in slices by range: a slice ends where the next one begins, in the order of the curve."""
    dealt = points.repartitionByRange(slices, *keys, F.desc("score"))
    return stage(dealt.withColumn("slice", F.spark_partition_id()), "curve-points")


def running_totals(points: DataFrame, *keys: str) -> DataFrame:
    """Positives (``tp``) and negatives (``fp``) down to each point, its own included; ``points`` has slices."""
    down = Window.partitionBy("slice", *keys).orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    within = points.withColumns({"tp": F.sum("hits").over(down), "fp": F.sum(F.col("n") - F.col("hits")).over(down)})
    parts = points.groupBy("slice", *keys).agg(F.sum("hits").alias("_hits"), F.sum(F.col("n") - F.col("hits")).alias("_others"))
    earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        F.col("slice").alias("_slice"), *[F.col(k).alias(f"_{k}") for k in keys],
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_hits", "_others")])
    same = F.col("slice") == F.col("_slice")
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    return within.join(carried, same).select(
        *keys, "score", "hits", "n", (F.col("tp") + F.col("_hits")).alias("tp"), (F.col("fp") + F.col("_others")).alias("fp"))


def areas_by(scored: DataFrame, *keys: str, slices: int | None = None) -> DataFrame:
    """Rows, positives and both areas of every group; an area that a group has no rows for is null.

    ``scored`` has ``label``, ``fraud_probability`` and the keys. The areas are sums of trapezoids; the precision-recall
    curve starts level with its first point.
    """
    wanted = slices or int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = running_totals(sliced(curve_points(scored, *keys), wanted, *keys), *keys)
    tp, fp, tp0 = F.col("tp"), F.col("fp"), F.col("tp") - F.col("hits")
    fp0 = fp - (F.col("n") - F.col("hits"))
    precision = tp / (tp + fp)
    before = F.coalesce(F.try_divide(tp0, tp0 + fp0), precision)
    summed = steps.groupBy(*keys).agg(
        F.sum("n").alias("reviews"), F.sum("hits").alias("positives"),
        F.sum((fp - fp0) * (tp + tp0) / 2.0).alias("_roc"), F.sum((tp - tp0) * (precision + before) / 2.0).alias("_pr"))
    negatives = F.col("reviews") - F.col("positives")
    return summed.select(
        *keys, "reviews", "positives",
        F.try_divide("_roc", F.col("positives").cast("double") * negatives).alias("roc_auc"),
        F.try_divide("_pr", F.col("positives").cast("double")).alias("pr_auc"))
