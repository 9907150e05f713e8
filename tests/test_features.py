import math

import pytest
from helpers import as_dict, day, reviews
from pyspark.sql import functions as F

from review_signals.config import CrossRules, SkewRule
from review_signals.operators import features as X
from review_signals.operators import history as H
from review_signals.operators import labels as L
from review_signals.schemas import FEATURE_COLUMNS, REVIEWER_FEATURES, TEXT_FEATURES

TEXTS = {
    # text: length, words, exclamation marks, shouted words, capitals
    "": (0, 1, 0, 0, 0),
    " a  b ": (6, 4, 0, 0, 0),
    "OK GO! I": (8, 3, 1, 1, 5),
    "USA!": (4, 1, 1, 0, 3),
    "so \U0001F600 GOOD!!": (11, 3, 2, 0, 4),
    "one\ttwo\nTHREE": (13, 3, 0, 1, 5),
    "AB CD\nEF A1": (11, 4, 0, 3, 7),
    "ÀÉ FÜR": (6, 2, 0, 0, 2),
}


def test_text_features(spark):
    rows = [dict(review_body=t, star_rating=5) for t in TEXTS] + [dict(review_body=None, star_rating=1)]
    got = X.with_text_features(reviews(spark, rows)).orderBy(F.expr("cast(substr(review_id, 2) as int)")).collect()
    for row, (text, (length, words, marks, shouted, capitals)) in zip(got, TEXTS.items()):
        assert [row[c] for c in TEXT_FEATURES[:4]] == [length, words, marks, shouted], text
        assert row["txt_caps_ratio"] == capitals / max(1, length), text
        assert row["txt_sentiment"] == 1.0
    assert [got[-1][c] for c in TEXT_FEATURES] == [0, 1, 0, 0, 0.0, -1.0]


def test_word_counts_equal_splitting_into_words(spark):
    """Word by word, in whole documents: the readable form of the same counts."""
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = F.split("text", r"\s+")
    both = documents.withColumn("star_rating", F.lit(3)).select(
        F.size(words).alias("words"), F.size(F.filter(words, lambda w: w.rlike("^[A-Z]{2,}$"))).alias("shouted"), "*"
    )
    got = X.with_text_features(both, "text")
    assert got.where("words <> txt_word_count or shouted <> txt_caps_word_count").count() == 0
    assert got.agg(F.sum("txt_caps_word_count")).first()[0] > 0


def test_reviewer_history(spark):
    rows = [dict(customer_id="one", star_rating=4)]
    rows += [dict(customer_id="two", star_rating=s, review_date=day(d), verified_purchase=v)
             for s, d, v in ((5, 0, True), (2, 0, False), (2, 9, None))]
    got = as_dict(H.reviewer_history(reviews(spark, rows)), "customer_id", *H.REVIEWER_LOOKUP)
    assert got["one"] == (1, 4.0, None, 1.0, 0, 1)
    total, mean, spread, verified, days, busiest = got["two"]
    assert (total, mean, verified, days, busiest) == (3, 3.0, 0.5, 9, 2)
    assert spread == pytest.approx(math.sqrt(3.0))


def test_equal_ratings_have_spread_zero(spark):
    got = H.reviewer_history(reviews(spark, [dict(star_rating=3)] * 7)).first()
    assert got["rh_rating_stddev"] == 0.0


def test_product_history(spark):
    rows = [dict(star_rating=5), dict(star_rating=5, review_date=day(3), verified_purchase=False), dict(star_rating=1)]
    got = as_dict(H.product_history(reviews(spark, rows)), "product_id", *H.PRODUCT_LOOKUP)
    assert got["p"] == (3, pytest.approx(11 / 3), pytest.approx(2 / 3), pytest.approx(2 / 3), 3)


def lookups(spark):
    seen = reviews(spark, [dict(customer_id="seen", product_id="seen", star_rating=s) for s in (5, 3)])
    return H.reviewer_history(seen), H.product_history(seen)


def test_unknown_keys_take_the_default_mean_and_zero_features(spark):
    rows = [dict(customer_id="seen", product_id="seen", star_rating=5), dict(customer_id="new", product_id="new",
                                                                             star_rating=5)]
    got = as_dict(X.enrich(reviews(spark, rows), *lookups(spark)), "review_id", "xf_rating_vs_reviewer",
                  "xf_rating_vs_product", "xf_extreme_review_neutral_product", "rev_total_reviews", "prod_avg_rating")
    assert got["r0"] == (1.0, 1.0, 1, 2, 4.0)
    assert got["r1"] == (2.0, 2.0, 0, 0, 0.0)


def test_neutral_band_is_a_parameter(spark):
    rows = reviews(spark, [dict(customer_id="seen", product_id="seen", star_rating=1)])
    narrow = X.enrich(rows, *lookups(spark), CrossRules(neutral_low=2.5, neutral_high=3.9))
    assert narrow.first()["xf_extreme_review_neutral_product"] == 0


def test_feature_table_layout(spark):
    labeled = L.label(reviews(spark, [dict(), dict(review_body=None), dict(customer_id=None)]))
    features = X.review_features(labeled)
    assert features.columns == ["review_id", "product_category", "is_likely_fraud", *FEATURE_COLUMNS]
    assert features.count() == 3
    assert features.dropna().count() == 3


def test_batch_features_equal_stream_features(spark):
    from review_signals.sources import standin as D

    documents = D.document_reviews(spark, "/root/testdata/sf0.001").fillna(False, subset=["is_likely_fraud"])
    people, goods = H.reviewer_history(documents), H.product_history(documents)
    one = X.enrich(documents, people, goods).select("review_id", *FEATURE_COLUMNS)
    for skew in (SkewRule(), SkewRule(hot_rows=5, max_hot_keys=5, salts=4)):
        for own in (("customer_id", "product_id"), ("product_id",), ()):
            other = X.review_features(documents, people, goods, own, skew=skew).select("review_id", *FEATURE_COLUMNS)
            assert one.exceptAll(other).count() == 0 and other.count() == documents.count()


def test_bodies_never_enter_a_shuffle(spark):
    from review_signals.sources import standin as D

    documents = D.document_reviews(spark, "/root/testdata/sf0.001")
    rows = documents.select("review_id", "customer_id", "product_id", "product_category", "star_rating",
                            "verified_purchase", "review_body", "review_date",
                            (F.col("star_rating") == 1).alias("is_likely_fraud"))
    path = spark.conf.get("spark.checkpoint.dir") + "/documents_as_reviews"
    rows.write.mode("overwrite").parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        features = X.review_features(spark.read.parquet(path))
        lines = features._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The join inputs are projections that hold numbers instead of the text.
    above = [line for line in lines if "Join" in line or "Aggregate" in line]
    assert above and not any("review_body" in line for line in above)
    body_at = [i for i, line in enumerate(lines) if "review_body" in line]
    last_join = max(i for i, line in enumerate(lines) if "Join LeftOuter" in line)
    assert body_at and min(body_at) > min(i for i, line in enumerate(lines) if "Join LeftOuter" in line)
    assert last_join >= 0
