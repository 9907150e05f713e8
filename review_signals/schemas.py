"""Fixed column names and schemas. They are the contract between the stages and are stated plainly."""

from __future__ import annotations

# --- fixed values: table layouts ---------------------------------------------------------------
RAW_TEXT_COLUMNS = (
    "marketplace",
    "review_id",
    "product_id",
    "product_title",
    "product_category",
    "review_headline",
    "review_body",
)

MESSAGE_SCHEMA = """
    review_id string, customer_id string, product_id string, product_category string,
    star_rating int, helpful_votes int, total_votes int, verified_purchase boolean,
    review_body string, review_date string, is_likely_fraud boolean
"""

MESSAGE_COLUMNS = (
    "review_id",
    "customer_id",
    "product_id",
    "product_category",
    "star_rating",
    "helpful_votes",
    "total_votes",
    "verified_purchase",
    "review_body",
    "review_date",
    "is_likely_fraud",
)

PREDICTION_SCHEMA = """
    review_id string, product_id string, product_category string, star_rating int,
    prediction double, fraud_probability double, timestamp timestamp
"""

PREDICTION_COLUMNS = (
    "review_id",
    "product_id",
    "product_category",
    "star_rating",
    "prediction",
    "fraud_probability",
    "timestamp",
)

# --- fixed values: feature names, in model order -------------------------------------------------
REVIEWER_FEATURES = (
    "rev_total_reviews",
    "rev_avg_rating",
    "rev_rating_stddev",
    "rev_pct_verified",
    "rev_days_active",
    "rev_max_per_day",
)

PRODUCT_FEATURES = (
    "prod_total_reviews",
    "prod_avg_rating",
    "prod_pct_5star",
    "prod_pct_verified",
    "prod_days_active",
)

TEXT_FEATURES = (
    "txt_body_length",
    "txt_word_count",
    "txt_exclamation_count",
    "txt_caps_word_count",
    "txt_caps_ratio",
    "txt_sentiment",
)

CROSS_FEATURES = (
    "xf_rating_vs_reviewer",
    "xf_rating_vs_product",
    "xf_extreme_review_neutral_product",
)

FEATURE_COLUMNS = REVIEWER_FEATURES + PRODUCT_FEATURES + TEXT_FEATURES + CROSS_FEATURES

# Never features: identifiers and the label in its two forms.
NON_FEATURES = frozenset({"review_id", "product_category", "is_likely_fraud", "label"})

# Features that repeat what the labelling rules look at; left out of the leakage-controlled model.
LEAKY_FEATURES = frozenset(
    {
        "rev_total_reviews",
        "rev_max_per_day",
        "rev_rating_stddev",
        "rev_days_active",
        "rev_pct_verified",
        "xf_rating_vs_reviewer",
        "xf_extreme_review_neutral_product",
    }
)

# The mean rating of a reviewer is a direct input of the bias rule, so the strict set drops it too.
STRICT_LEAKY_FEATURES = LEAKY_FEATURES | {"rev_avg_rating"}
# --------------------------------------------------------------------------------------------------
