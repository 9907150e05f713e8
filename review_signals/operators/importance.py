"""Importance of features on held-out rows: how much the ROC area falls when one feature is taken from another row.

Works for a fixed rule and for a trained model alike. Rows are dealt to blocks by a hash of their id, and within a block
each row gets the next row's features in the order of a second hash, the last one those of the first: a permutation that
depends on the ids only, not on the layout. One window per block brings the neighbour's features for all features at once;
every row then becomes one row as it is and one per feature, and all of these are scored in one pass. The areas of
all of them come from one distributed prefix sum, so no group of rows is ever sorted in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_signals.functions.scalars import key_bucket
from review_signals.operators.ranking import areas_by

#: Seeds of the two hashes; the blocks' one differs from the split's, whose sides it would otherwise follow.
BLOCK_SEED, ORDER_SEED = 101, 102
#: The name of the rows as they are.
UNCHANGED = ""


def with_neighbour(rows: DataFrame, features: Sequence[str], key: str, blocks: int) -> DataFrame:
    """Beside each row ``_other``, the features of the row after it; a block of one row is its own neighbour.

    Ids that repeat share a place in the order; which of their rows comes first is decided by the features.
    """
    order = F.md5(F.concat(F.lit(f"{ORDER_SEED}:"), F.col(key).cast("string")))
    placed = rows.withColumn("_block", key_bucket(F.coalesce(F.col(key).cast("string"), F.lit("")), BLOCK_SEED, blocks))
    down = Window.partitionBy("_block").orderBy(order, key, *features)
    whole = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.struct(*features)
    return placed.withColumn("_other", F.coalesce(F.lead(own).over(down), F.first(own).over(whole))).drop("_block")


def permuted(rows: DataFrame, features: Sequence[str], key: str, blocks: int) -> DataFrame:
    """Each row as it is, and once per feature with the neighbour's value of it, named in ``permuted``."""
    variants = F.explode(F.array(*[F.lit(name) for name in (UNCHANGED, *features)])).alias("permuted")
    spread = with_neighbour(rows, features, key, blocks).select("*", variants)
    swapped = {f: F.when(F.col("permuted") == f, F.col(f"_other.{f}")).otherwise(F.col(f)) for f in features}
    return spread.withColumns(swapped).drop("_other")


def permutation_importance(rows: DataFrame, features: Sequence[str], score: Callable[[DataFrame], DataFrame],
                           key: str = "review_id", blocks: int = 200) -> DataFrame:
    """Per feature the area with it permuted, and by how much that is less than the area of the rows as they are.

    ``rows`` have ``label``, the key and the features, which must not be called ``permuted``; ``score`` adds
    ``fraud_probability`` and keeps the other columns. ``blocks`` should leave some 100,000 rows to a block. Without rows of both classes
    all areas are null; without rows there is no result.
    """
    narrow = rows.select(key, "label", *features)
    scored = score(permuted(narrow, features, key, blocks)).select("permuted", "label", "fraud_probability")
    areas = areas_by(scored, "permuted")
    # the window runs over one row per feature and the unchanged one
    unchanged = F.max(F.when(F.col("permuted") == UNCHANGED, F.col("roc_auc"))).over(Window.partitionBy())
    found = areas.withColumn("whole_auc", unchanged).where(F.col("permuted") != UNCHANGED)
    return found.select(
        F.col("permuted").alias("feature"), "reviews", "positives", "whole_auc", F.col("roc_auc").alias("permuted_auc"),
        (F.col("whole_auc") - F.col("roc_auc")).alias("importance"))
