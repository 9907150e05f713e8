"""Model features. Batch training and stream scoring use the very same functions."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_signals.config import CrossRules, SkewRule
from review_signals.functions.scalars import as_int
from review_signals.functions.text import text_feature_columns
from review_signals.operators.history import (
    as_product_features,
    as_reviewer_features,
    product_history,
    reviewer_history,
)
from review_signals.operators.skew import attach, key_sizes
from review_signals.schemas import FEATURE_COLUMNS, REVIEWER_FEATURES, TEXT_FEATURES


def with_text_features(reviews: DataFrame, body: str = "review_body") -> DataFrame:
    return reviews.withColumns(text_feature_columns(F.col(body), F.col("star_rating")))


def with_cross_features(rows: DataFrame, rules: CrossRules = CrossRules()) -> DataFrame:
    """Rating against the means of its reviewer and product; an unknown mean counts as ``unknown_mean``."""
    stars = F.col("star_rating")

    def above(mean: str):
        return stars - F.coalesce(F.col(mean), F.lit(rules.unknown_mean))

    extreme = stars.isin(1, 5) & F.col("prod_avg_rating").between(rules.neutral_low, rules.neutral_high)
    return rows.withColumns(
        {
            "xf_rating_vs_reviewer": above("rev_avg_rating"),
            "xf_rating_vs_product": above("prod_avg_rating"),
            "xf_extreme_review_neutral_product": as_int(extreme),
        }
    )


def fill_features(rows: DataFrame) -> DataFrame:
    """Missing feature values as 0. Runs after the cross features, which know their own default."""
    return rows.fillna(0, subset=list(FEATURE_COLUMNS))


def behaviour_features(
    rows: DataFrame,
    reviewers: DataFrame | None,
    products: DataFrame,
    own: Collection[str] = (),
    rules: CrossRules = CrossRules(),
    skew: SkewRule = SkewRule(),
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Reviewer, product and cross features for rows that carry their text features already.

    ``own`` names the keys (customer_id, product_id) whose lookup was computed from these very rows, so that its totals
    tell how many rows each key has here. For the other key (lookups of the training part only) the rows are counted,
    or ``keys_from``, a frame with the same keys that is cheaper to compute. Without ``reviewers`` the rows carry the
    reviewer features already.
    """
    counted = rows if keys_from is None else keys_from

    def sizes(key: str, total: str) -> dict:
        return {"size": total} if key in own else {"sizes": key_sizes(counted, [key])}

    joined = rows
    if reviewers is not None:
        people, by_reviewer = as_reviewer_features(reviewers), sizes("customer_id", "rev_total_reviews")
        joined = attach(joined, people, ["customer_id"], salt_by=["review_id"], rule=skew, **by_reviewer)
    goods, by_product = as_product_features(products), sizes("product_id", "prod_total_reviews")
    joined = attach(joined, goods, ["product_id"], salt_by=["review_id"], rule=skew, **by_product)
    return with_cross_features(joined, rules)


def review_features(
    labeled: DataFrame,
    reviewers: DataFrame | None = None,
    products: DataFrame | None = None,
    own: Collection[str] = (),
    rules: CrossRules = CrossRules(),
    skew: SkewRule = SkewRule(),
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """The feature table: review_id, product_category, is_likely_fraud and the twenty features.

    A history that is not given is that of ``labeled`` itself. Reviewer features that ``labeled`` has already (from
    :func:`labels.label`) are taken as they are. The text is measured first, so the bodies never enter a shuffle.
    """
    carried = [c for c in REVIEWER_FEATURES if c in labeled.columns] if reviewers is None else []
    if reviewers is None and not carried:
        reviewers, own = reviewer_history(labeled), {*own, "customer_id"}
    if products is None:
        products, own = product_history(labeled), {*own, "product_id"}
    measured = labeled if TEXT_FEATURES[0] in labeled.columns else with_text_features(labeled)
    slim = measured.select(
        "review_id", "customer_id", "product_id", "product_category", "is_likely_fraud", "star_rating",
        *TEXT_FEATURES, *carried,
    )
    joined = behaviour_features(slim, reviewers, products, own, rules, skew, keys_from)
    return fill_features(joined.select("review_id", "product_category", "is_likely_fraud", *FEATURE_COLUMNS))


def enrich(reviews: DataFrame, reviewers: DataFrame, products: DataFrame,
           rules: CrossRules = CrossRules()) -> DataFrame:
    """Features of incoming reviews from saved lookups; unknown reviewers and products stay.

    On a stream these are plain left joins: Spark broadcasts a lookup only if its size allows, and the rows
    of a hot key are no more than the bounded batch holds. Large lookups are best saved bucketed, then only
    the incoming rows move. On a table of any size hot keys are spread.
    """
    rows = with_text_features(reviews).drop("review_body")
    if not reviews.isStreaming:
        return fill_features(behaviour_features(rows, reviewers, products, (), rules, keys_from=reviews))
    joined = rows.join(as_reviewer_features(reviewers), "customer_id", "left").join(
        as_product_features(products), "product_id", "left"
    )
    return fill_features(with_cross_features(joined, rules))
