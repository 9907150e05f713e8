"""Every operator as a named query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_signals.config import AlertRule, ForestSettings, LabelRules, SERVING_THRESHOLD
from review_signals.functions.scalars import date_from_epoch_days, flagged, helpful_ratio
from review_signals.operators import curate as C
from review_signals.operators import features as X
from review_signals.operators import history as H
from review_signals.operators import importance as I
from review_signals.operators import labels as L
from review_signals.operators import metrics as Q
from review_signals.operators import model as M
from review_signals.operators import monitor as W
from review_signals.operators import profile as P
from review_signals.operators import ranking as A
from review_signals.operators import rolling as R
from review_signals.operators import split as S
from review_signals.operators import tallies as B
from review_signals.schemas import FEATURE_COLUMNS, MESSAGE_COLUMNS, REVIEWER_FEATURES, TEXT_FEATURES
from review_signals.sources import messages as J
from review_signals.sources import standin as D
from review_signals.session import shared_dir
from review_signals.sources.tables import read_layouts, read_table, replace_partitions, stage, unstage, write_by_category
from review_signals.streaming import fan_out as O
from review_signals.streaming import progress as G
from review_signals.streaming import scoring as T

Query = Callable[[SparkSession, str], DataFrame]

# The events are sparse, so the alert windows are wider than the default.
EVENT_ALERTS = AlertRule(window="6 hours", slide="3 hours")
CURATED_CATEGORIES = ("MEDIUM", "PROMO", "SMALL")
SPLIT_COLUMNS = ("review_id", "customer_id", "product_id")
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(rows: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return rows.withColumns({c: F.round(c, digits) for c in columns})


def with_missing(rows: DataFrame, *columns: str) -> DataFrame:
    """Beside each column a flag that is never null: a gap and an empty value can't be mixed up."""
    return rows.withColumns({f"{c}_missing": F.col(c).isNull() for c in columns})


def as_text(rows: DataFrame, *columns: str) -> DataFrame:
    """Dates, times and flags as text, gaps as empty text: a result then reads the same in every client. Where gaps can
    occur, :func:`with_missing` tells them from empty values."""
    return rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


# --- scans and messages ---------------------------------------------------------------------------


@query
def scan_profile(spark, d):
    return P.column_profile(read_table(spark, f"{d}/documents*.parquet"))


@query
def scan_sample(spark, d):
    documents = D.table(spark, d, "documents")
    return P.sample_rows(documents, "doc_id", ["lang", "source"], "text")


@query
def json_encode(spark, d):
    return J.encode_messages(D.document_reviews(spark, d))


def _damaged_messages(spark, d):
    """Encoded reviews, about one in eleven of them cut off, as some transport might do."""
    text = F.col("value")
    cut = F.when(F.length(text) % 11 == 0, F.substring(text, 1, 40)).otherwise(text)
    return J.encode_messages(D.document_reviews(spark, d)).select(
        cut.cast("binary").alias("value"), F.lit(None).cast("timestamp").alias("timestamp")
    )


@query
def json_decode(spark, d):
    messages = J.encode_messages(D.document_reviews(spark, d)).select(
        F.col("value").cast("binary").alias("value"), F.lit(None).cast("timestamp").alias("timestamp")
    )
    decoded = J.valid_messages(J.decode_messages(messages)).select(*MESSAGE_COLUMNS)
    return as_text(with_missing(decoded, "is_likely_fraud"), "is_likely_fraud")


@query
def json_dead_letters(spark, d):
    return J.dead_letters(J.decode_messages(_damaged_messages(spark, d))).groupBy("malformed").agg(
        F.count("*").alias("messages")
    )


# --- curation -------------------------------------------------------------------------------------


@query
def curate_reviews(spark, d):
    return as_text(C.curate(D.raw_reviews(spark, d), CURATED_CATEGORIES), "review_date")


@query
def epoch_day_to_date(spark, d):
    days = D.raw_reviews(spark, d).select("review_date")
    dated = days.groupBy("review_date", date_from_epoch_days(F.col("review_date")).alias("as_date"))
    return as_text(dated.agg(F.count("*").alias("reviews")), "as_date")


# --- profiles -------------------------------------------------------------------------------------


@query
def category_counts(spark, d):
    return P.category_counts(D.reviews(spark, d))


@query
def rating_counts(spark, d):
    return P.rating_counts(D.reviews(spark, d))


@query
def verified_counts(spark, d):
    return P.verified_counts(D.reviews(spark, d))


@query
def rating_by_category(spark, d):
    return P.rating_by_category(D.reviews(spark, d), D.CATEGORIES)


@query
def verified_by_category(spark, d):
    return P.verified_by_category(D.reviews(spark, d))


@query
def helpful_ratio_histogram(spark, d):
    return rounded(P.helpful_ratio_histogram(D.reviews(spark, d)), "low", "high")


@query
def helpful_ratio_histogram_10(spark, d):
    return rounded(P.helpful_ratio_histogram(D.reviews(spark, d), bins=10), "low", "high")


@query
def helpful_ratio_sampled(spark, d):
    return rounded(P.helpful_ratio_histogram(D.reviews(spark, d), fraction=0.01), "low", "high")


@query
def helpful_extremes(spark, d):
    return rounded(P.helpful_extremes(D.reviews(spark, d)), "share_none_helpful", "share_all_helpful")


@query
def reviewer_activity(spark, d):
    return P.reviewer_activity(D.reviews(spark, d))


@query
def heavy_reviewers(spark, d):
    return rounded(P.heavy_reviewers(D.reviews(spark, d)), "review_share")


@query
def daily_velocity(spark, d):
    return as_text(P.daily_velocity(D.reviews(spark, d)), "review_date")


@query
def weekday_velocity(spark, d):
    return rounded(P.weekday_velocity(D.reviews(spark, d)), "mean_per_day")


@query
def velocity_spikes(spark, d):
    return as_text(rounded(P.velocity_spikes(D.reviews(spark, d)), "baseline", "ratio"), "review_date")


@query
def top_reviewers(spark, d):
    return rounded(P.top_reviewers_in_period(D.reviews(spark, d)), "per_day_of_period")


@query
def top_reviewer_rate(spark, d):
    return rounded(P.top_reviewers(D.reviews(spark, d)), "per_day")


@query
def verified_share(spark, d):
    return rounded(P.verified_share(D.reviews(spark, d)), "verified_share")


@query
def rating_share(spark, d):
    return rounded(P.rating_share(D.reviews(spark, d)), "review_share")


@query
def extreme_by_verified(spark, d):
    return rounded(P.extreme_by_verified(D.reviews(spark, d)), "extreme_share")


@query
def entity_counts(spark, d):
    return P.entity_counts(D.reviews(spark, d))


@query
def entity_sketches(spark, d):
    """Distinct reviewers and products per category from sketches that were kept per category and day, held against
    exact counts."""
    rows = D.reviews(spark, d)
    kept = stage(P.entity_sketches(rows, "product_category", "review_date"), "sketches")
    exact = rows.groupBy("product_category").agg(
        F.count_distinct("customer_id").alias("exact_reviewers"), F.count_distinct("product_id").alias("exact_products"))
    both = P.merged_entities(kept, "product_category").join(exact, "product_category")
    close = [(F.abs(F.col(c) - F.col(f"exact_{c}")) <= 0.02 * F.col(f"exact_{c}")).alias(f"{c}_close") for c in ("reviewers", "products")]
    return both.select("product_category", "reviews", "exact_reviewers", "exact_products", *close)


# --- windows and labels ---------------------------------------------------------------------------


@query
def burst_window(spark, d):
    windows = L.with_reviewer_windows(D.reviews(spark, d))
    return as_text(windows.select("review_id", "customer_id", "review_date", "rolling_24h_count"), "review_date")


@query
def reviewer_window_stats(spark, d):
    stats = L.with_reviewer_windows(D.reviews(spark, d)).select(
        "review_id", "reviewer_total_reviews", "reviewer_avg_rating"
    )
    return rounded(stats, "reviewer_avg_rating")


@query
def burst_window_24h(spark, d):
    events = D.table(spark, d, "events").select("event_id", "user_id", "ts")
    return R.rolling_counts(events, "user_id", "ts", "event_id", name="rolling_24h_count").drop("ts")


@query
def h1_low_helpful(spark, d):
    rows = D.reviews(spark, d)
    ratio = F.round(helpful_ratio(F.col("helpful_votes"), F.col("total_votes")), 6)
    return rows.select(
        "review_id", "helpful_votes", "total_votes", ratio.alias("helpful_ratio"),
        L.low_helpful().alias("h1_low_helpful"),
    )


@query
def h2_burst(spark, d):
    windows = L.with_reviewer_windows(D.reviews(spark, d))
    return windows.select("review_id", L.burst().alias("h2_burst_activity"))


@query
def h3_extreme_bias(spark, d):
    windows = L.with_reviewer_windows(D.reviews(spark, d))
    return windows.select("review_id", L.extreme_bias().alias("h3_extreme_bias"))


@query
def label_reviews(spark, d):
    return as_text(L.label(D.reviews(spark, d)), "review_date")


@query
def heuristic_counts(spark, d):
    counted = L.heuristic_counts(L.label(D.reviews(spark, d))).drop("in_band")
    return rounded(counted, "h1_rate", "h2_rate", "h3_rate", "any_rate")


@query
def label_rate_gate(spark, d):
    counted = L.heuristic_counts(L.label(D.reviews(spark, d))).select("reviews", "any_rate", "in_band")
    return rounded(counted, "any_rate")


@query
def threshold_sweep(spark, d):
    swept = L.burst_threshold_sweep(D.reviews(spark, d), [3, 5, 8, 10], LabelRules())
    return rounded(swept, "h2_rate", "any_rate")


# --- splits and samples ---------------------------------------------------------------------------


@query
def entity_split(spark, d):
    return S.entity_split(D.reviews(spark, d))


@query
def split_balance(spark, d):
    return rounded(S.split_balance(L.label(D.reviews(spark, d))), "row_share", "positive_rate")


@query
def split_semi_join(spark, d):
    rows = D.reviews(spark, d)
    buyers = D.table(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING")
    keys = buyers.select(F.col("c_custkey").cast("string").alias("customer_id"))
    return S.restrict_to_keys(rows, keys, "customer_id").select(*SPLIT_COLUMNS)


@query
def train_test_union(spark, d):
    rows = D.reviews(spark, d)
    sides = [part(rows).withColumn("split", F.lit(name)) for name, part in
             (("train", S.train_part), ("test", S.test_part))]
    return sides[0].unionByName(sides[1]).select(*SPLIT_COLUMNS, "split")


@query
def row_split(spark, d):
    return S.with_split(D.reviews(spark, d), key="review_id").select("review_id", "split")


@query
def key_sample(spark, d):
    return S.key_sample(D.reviews(spark, d), "review_id", 0.01).select(*SPLIT_COLUMNS)


@query
def key_sample_small(spark, d):
    return S.key_sample(D.reviews(spark, d), "review_id", 0.00055).select(*SPLIT_COLUMNS)


# --- histories and features -----------------------------------------------------------------------

LOOKUP_ROUNDING = ("rh_avg_rating", "rh_rating_stddev", "rh_pct_verified")
PRODUCT_ROUNDING = ("ph_avg_rating", "ph_pct_5star", "ph_pct_verified")
FEATURE_ROUNDING = (
    "rev_avg_rating", "rev_rating_stddev", "rev_pct_verified", "prod_avg_rating", "prod_pct_5star",
    "prod_pct_verified", "txt_caps_ratio", "txt_sentiment", "xf_rating_vs_reviewer", "xf_rating_vs_product",
)


@query
def reviewer_lookup(spark, d):
    return rounded(H.reviewer_history(S.train_part(D.reviews(spark, d))), *LOOKUP_ROUNDING)


@query
def product_lookup(spark, d):
    return rounded(H.product_history(S.train_part(D.reviews(spark, d))), *PRODUCT_ROUNDING)


def _kept_up_to_date(spark, d, key):
    """The history after three batches of reviews that came one by one, the second of them twice; days are spread over
    batches, and the last batch meets compacted sums."""
    base, lookup = _workspace(spark), None
    part = (F.crc32(F.col("review_id").cast("binary")) % 3).alias("part")
    # joined once and written, with no more than the sums need: every batch reads it
    rows = stage(D.reviews(spark, d).select(key, "review_date", "star_rating", "verified_purchase", part), "reviews")
    store = f"{base}/batches"
    for number, batch in enumerate((0, 1, 1, 2)):
        if number == 3:
            B.compact(B.read_batches(spark, store), f"{base}/compacted", key)
            store = f"{base}/compacted"
        B.add_batch(rows.where(F.col("part") == batch), store, key, batch + 1)
        lookup = stage(B.refreshed(lookup, B.read_batches(spark, store), key, batch + 1), "lookup")
    return lookup


@query
def history_merge(spark, d):
    return rounded(_kept_up_to_date(spark, d, "customer_id"), *LOOKUP_ROUNDING)


@query
def product_history_merge(spark, d):
    return rounded(_kept_up_to_date(spark, d, "product_id"), *PRODUCT_ROUNDING)


@query
def text_features(spark, d):
    documents = D.document_reviews(spark, d)
    measured = X.with_text_features(documents).select("review_id", *X.TEXT_FEATURES)
    return rounded(measured, "txt_caps_ratio", "txt_sentiment")


@query
def cross_features(spark, d):
    read = ("review_id", *OWN_KEYS, "star_rating", "verified_purchase", "review_date")
    # joined once and written: both histories and the features read it
    rows = stage(D.reviews(spark, d).select(*read), "reviews").withColumns({c: F.lit(0) for c in X.TEXT_FEATURES})
    joined = X.behaviour_features(rows, H.reviewer_history(rows), H.product_history(rows), OWN_KEYS)
    cross = joined.select("review_id", "xf_rating_vs_reviewer", "xf_rating_vs_product",
                          "xf_extreme_review_neutral_product")
    return rounded(cross, "xf_rating_vs_reviewer", "xf_rating_vs_product")


OWN_KEYS = ("customer_id", "product_id")


def _measured(spark, d):
    """Reviews with the figures of their texts, joined once and written, as histories, labels and features read them."""
    return stage(D.reviews(spark, d, with_text=True), "reviews")


def _labelled(rows, reviewers):
    """Labelled reviews with their reviewer's features: they travel to the reviewers once, for both. The rules count a
    review once, however many documents share its text's id."""
    return L.label(rows, reviewers=H.as_reviewer_features(reviewers), counted=rows.where("first_text"))


def _described(spark, d, known=lambda rows: rows):
    """Labelled reviews with their reviewers' features, and the history of the products, both from the ``known`` reviews.

    The histories and the labelled reviews are written one after the other. The shuffles of a step, and the reviews when
    they have been labelled, are gone before the next one: the disks hold the reviews on one way at a time, not on all.
    """
    rows = _measured(spark, d)
    reviewers, products = stage(H.reviewer_history(known(rows)), "reviewers"), stage(H.product_history(known(rows)), "products")
    labeled = stage(_labelled(rows, reviewers).select(*DESCRIBED), "labelled")
    unstage(rows)
    unstage(reviewers)
    return labeled, products


# What the features are made of once reviews are labelled.
DESCRIBED = (*SPLIT_COLUMNS, "product_category", "is_likely_fraud", "star_rating", *TEXT_FEATURES, *REVIEWER_FEATURES)


def _features(spark, d):
    labeled, products = _described(spark, d)
    return X.review_features(labeled, products=products, own={"product_id"})


@query
def review_features(spark, d):
    return rounded(_features(spark, d), *FEATURE_ROUNDING)


@query
def train_history_features(spark, d):
    """All reviews, with the history of the training reviewers only: what a leak-free evaluation uses."""
    labeled, products = _described(spark, d, S.train_part)
    return rounded(X.review_features(labeled, products=products), *FEATURE_ROUNDING)


@query
def enriched_reviews(spark, d):
    """Document reviews against lookups made of their own training part: unseen reviewers stay."""
    rows = D.document_reviews(spark, d)
    train = S.train_part(rows, key="review_id")
    joined = X.enrich(rows, H.reviewer_history(train), H.product_history(train))
    return rounded(joined.select("review_id", *FEATURE_COLUMNS), *FEATURE_ROUNDING)


# --- models and metrics ---------------------------------------------------------------------------


@query
def label_distribution(spark, d):
    return Q.label_distribution(Q.with_label(L.label(D.reviews(spark, d))))


def _rule_scored(spark, d):
    return Q.with_label(D.rule_scored(L.label(D.reviews(spark, d))))


@query
def confusion_matrix(spark, d):
    return rounded(Q.confusion(_rule_scored(spark, d)), "row_share")


@query
def confusion_by_category(spark, d):
    return rounded(Q.confusion(_rule_scored(spark, d), "product_category"), "row_share")


METRIC_COLUMNS = ("accuracy", "weighted_precision", "weighted_recall", "f1")


@query
def weighted_metrics(spark, d):
    return rounded(Q.weighted_metrics(_rule_scored(spark, d)), *METRIC_COLUMNS)


@query
def metrics_by_category(spark, d):
    return rounded(Q.weighted_metrics(_rule_scored(spark, d), "product_category"), *METRIC_COLUMNS)


@query
def feature_stddev(spark, d):
    features = _features(spark, d)
    scale = rounded(M.fitted_scale(features), "scale")
    unstage(features)
    return scale


#: Area under the ROC curve on held-out rows that a right forest reaches; a scorer that knows nothing has 0.5.
RANKED = 0.9


@query
def score_reviews(spark, d):
    """Train on the training rows, save and load the model, score the held-out rows. Scores depend on the forest, so what
    must hold for any right one is shown: it ranks well, scores are shares, and verdicts follow from them."""
    described = _features(spark, d)
    features = stage(described, "features")
    unstage(described)
    path = f"{_workspace(spark)}/model"
    M.save(M.train(S.train_part(features, key="review_id"), ForestSettings()), path)
    scored = M.score(S.test_part(features, key="review_id"), M.load(path), SERVING_THRESHOLD)
    scored = stage(Q.with_label(scored).select(
        "review_id", "product_category", "is_likely_fraud", "label", "fraud_probability", "prediction"), "scored")
    unstage(features)
    # what a right forest reaches: it ranks nearly all held-out positives over nearly all others
    reached = M.areas(scored)["roc_auc"] >= RANKED
    score = F.col("fraud_probability")
    verdict = F.when(score >= SERVING_THRESHOLD, 1.0).otherwise(0.0)
    return scored.select(
        "review_id", "product_category", "is_likely_fraud", F.lit(reached).alias("ranks_well"),
        score.between(0.0, 1.0).alias("score_is_share"), (F.col("prediction") == verdict).alias("verdict_follows"),
    )


def _ranked(spark, d, score: str):
    """Events with a label, and a score by one of two rules, at least 0.3 of which is a hit."""
    events = D.predictions(spark, d)
    scores = {"by_value": F.col("fraud_probability"), "by_number": (F.col("review_id").cast("bigint") * 37 % 997) / 997}
    return events.select(
        F.when(F.col("star_rating") >= 4, 1.0).otherwise(0.0).alias("label"), scores[score].alias("fraud_probability")
    ).withColumn("prediction", flagged(F.col("fraud_probability"), 0.3))


@query
def ranking_metrics(spark, d):
    found = M.evaluate(_ranked(spark, d, "by_value"), "by_value")
    return rounded(found.select("model", "roc_auc", "pr_auc"), "roc_auc", "pr_auc")


@query
def ranking_by_category(spark, d):
    events = D.predictions(spark, d)
    labelled = events.withColumn("label", F.when(F.col("star_rating") >= 4, 1.0).otherwise(0.0))
    return rounded(A.areas_by(labelled, "product_category"), "roc_auc", "pr_auc")


@query
def model_comparison(spark, d):
    both = [M.evaluate(_ranked(spark, d, score), score) for score in ("by_value", "by_number")]
    return rounded(M.compare(*both), "by_value", "by_number")


RULE_FEATURES = ("star_rating", "txt_caps_ratio", "txt_body_length", "helpful_votes", "verified_purchase")


def _loud_rule(rows):
    """A fixed rule that looks at four of its five features; the length counts by steps of 500 characters."""
    far = F.abs(F.col("star_rating") - 3) / 2
    score = 4 * F.round("txt_caps_ratio", 6) - F.floor(F.col("txt_body_length") / 500) / 10 + far / 8
    return rows.withColumn("fraud_probability", F.round(score + F.when(F.col("verified_purchase"), 0.0).otherwise(0.05), 6))


@query
def rule_importance(spark, d):
    """What each feature is worth to a fixed rule, on the held-out documents."""
    rows = Q.with_label(S.test_part(D.document_reviews(spark, d), key="review_id"))
    found = I.permutation_importance(X.with_text_features(rows), RULE_FEATURES, _loud_rule, blocks=4)
    return rounded(found, "whole_auc", "permuted_auc", "importance")


@query
def apply_threshold(spark, d):
    events = D.table(spark, d, "events")
    score = F.col("value") / D.EVENT_SCALE
    return events.select("event_id", flagged(score, SERVING_THRESHOLD).alias("prediction"))


# --- writes and streams ---------------------------------------------------------------------------


def _workspace(spark):
    return f"{shared_dir(spark)}/queries/{uuid.uuid4().hex}"


@query
def partitioned_roundtrip(spark, d):
    """The curated table written by category, and one category read back."""
    path = _workspace(spark)
    write_by_category(D.reviews(spark, d), path)
    kept = read_table(spark, path).where(F.col("product_category") == "PROMO")
    return as_text(kept.select(*SPLIT_COLUMNS, "product_category", "star_rating", "review_date"), "review_date")


def _worked_off(started):
    started.awaitTermination()
    if started.exception():
        raise started.exception()


@query
def stream_sliding_alerts(spark, d):
    """Predictions that arrive in two parts, each worked off by a start of the same query: closed windows, once each."""
    base, rows = _workspace(spark), D.predictions(spark, d)
    middle = rows.agg(F.percentile_approx(F.unix_micros(F.col("timestamp").cast("timestamp")), 0.5)).first()[0]
    early = F.unix_micros(F.col("timestamp").cast("timestamp")) <= middle
    typed = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    for part in (typed.where(early), typed.where(~early)):
        part.write.mode("append").parquet(f"{base}/in")
        alerts = W.sliding_alerts(T.prediction_stream(spark, f"{base}/in"), EVENT_ALERTS, keys=("product_category",))
        _worked_off(T.start_sink(alerts, f"{base}/out", "alerts", f"{base}/checkpoint", interval=None))
    return as_text(rounded(spark.read.parquet(f"{base}/out"), "avg_fraud_prob"), "window_start", "window_end")


@query
def stream_progress(spark, d):
    """What the log of a query says of predictions that come in two parts, both from the whole time: the second brings
    late ones. Windows that were dropped as late, windows still open at the end, and the last watermark."""
    base, rows = _workspace(spark), D.predictions(spark, d)
    typed = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    second = F.col("review_id").cast("bigint") % 2 == 1
    with G.ProgressLog(spark, f"{base}/progress") as log:
        for part in (typed.where(~second), typed.where(second)):
            part.write.mode("append").parquet(f"{base}/in")
            alerts = W.sliding_alerts(T.prediction_stream(spark, f"{base}/in"), EVENT_ALERTS, keys=("product_category",))
            started = T.start_sink(alerts, f"{base}/out", "late_alerts", f"{base}/checkpoint", interval=None)
            _worked_off(started)
            log.await_end(started)
    seen = G.progress_by_query(G.read_progress(spark, f"{base}/progress"))
    return seen.select("name", "late_groups", "state_rows", "watermark")


@query
def partition_refresh(spark, d):
    """One category of a written table is replaced, with every rating turned around; the others keep their files."""
    path, rows = _workspace(spark), D.reviews(spark, d)
    write_by_category(rows, path)
    turned = rows.where(F.col("product_category") == "PROMO").withColumn("star_rating", (6 - F.col("star_rating")).cast("int"))
    replace_partitions(turned, path, "product_category")
    return read_table(spark, path).select(*SPLIT_COLUMNS, "product_category", "star_rating")


@query
def scan_files(spark, d):
    """Documents in files of two layouts: ids as text and no language, and all columns as they are given. Every task writes
    a file of its own, and the profiles of a layout's files are added up."""
    base, documents = _workspace(spark), D.table(spark, d, "documents")
    first = F.col("doc_id") % 3 == 0
    old = documents.where(first).select(F.col("doc_id").cast("string").alias("DOC_ID"), "text", F.col("n_chars").cast("int"))
    old.write.parquet(f"{base}/old")
    documents.where(~first).write.parquet(f"{base}/new")
    rows = read_layouts(spark, "doc_id bigint, lang string, source string, n_chars bigint", f"{base}/old", f"{base}/new")
    folder = F.element_at(F.split("file", "/"), -2).alias("layout")
    profile = P.file_profile(rows, "doc_id", "lang", "source", "n_chars")
    chars = rows.groupBy("file").agg(F.sum("n_chars").alias("chars"), F.max("doc_id").alias("last_id"))
    sums = [F.sum(c).alias(c) for c in (*profile.columns[1:], "chars")]
    return profile.join(chars, "file").groupBy(folder).agg(*sums, F.max("last_id").alias("last_id"))


EVENT_WINDOWS = AlertRule(window="2 hours", slide="1 hour", min_hits=3)
STREAM_THRESHOLD = 0.5


def _rule_score(reviewers, products):
    """A fixed rule as the scorer: how far a rating is from the product's mean, and how loud the text is."""

    def score(rows):
        enriched = X.enrich(rows, reviewers, products)
        joined = rows.select("review_id", "product_id", "star_rating", "timestamp").join(
            enriched.select("review_id", "product_category", *FEATURE_COLUMNS), "review_id")
        apart = F.abs(F.round("xf_rating_vs_product", 6)) / 4
        score = F.round(apart + F.round("txt_caps_ratio", 6), 6)
        return joined.withColumn("fraud_probability", score).withColumn("prediction", flagged(score, STREAM_THRESHOLD))

    return score


def _fanned_out(spark, d):
    """All documents as messages, some of them broken, through one pass that fills three tables. They come in two parts;
    the second batch is then worked off again, as after a failure between its writes and the commit."""
    base, rows = _workspace(spark), D.document_reviews(spark, d)
    train = S.train_part(rows, key="review_id")
    score = _rule_score(stage(H.reviewer_history(train), "reviewers"), stage(H.product_history(train), "products"))
    text = F.col("value")
    cut = F.when(F.length(text) % 11 == 0, F.substring(text, 1, 40)).otherwise(text)
    minute = F.timestamp_seconds(F.col("key").cast("bigint") * 60)
    envelopes = J.encode_messages(rows).select(cut.cast("binary").alias("value"), minute.alias("timestamp"), "key")
    for part in (0, 1, None):
        if part is None:
            _forget_commit(spark, f"{base}/checkpoint", batch=1)
        else:
            own = envelopes.where(F.crc32(F.col("key").cast("binary")) % 2 == part).drop("key")
            own.write.mode("append").parquet(f"{base}/in")
        _worked_off(O.start_fan_out(J.file_stream(spark, f"{base}/in"), f"{base}/out", score, f"{base}/checkpoint", None,
                                    EVENT_WINDOWS, ("product_category",)))
    return f"{base}/out"


def _forget_commit(spark, checkpoint, batch):
    """The state of a query that has written a batch and then failed: the batch is planned and not committed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{batch}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.delete(path, False):
        raise FileNotFoundError(path.toString())
    files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/.{batch}.crc"), False)


@query
def stream_scored(spark, d):
    scored = O.read_complete(spark, _fanned_out(spark, d), "predictions")
    return scored.select("review_id", "product_id", "product_category", "star_rating", "prediction", "fraud_probability")


@query
def stream_fan_out_alerts(spark, d):
    """Alerts from sums that were counted batch by batch."""
    found = O.alerts(O.read_complete(spark, _fanned_out(spark, d), "hits"), EVENT_WINDOWS, ("product_category",))
    return as_text(rounded(found, "avg_fraud_prob"), "window_start", "window_end")


@query
def stream_batch_counts(spark, d):
    """What was counted while the batches were written, over all of them."""
    counted = O.read_batches(spark, _fanned_out(spark, d))
    return counted.agg(F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in ("messages", "broken", "scored", "flagged")])


@query
def stream_json_decode(spark, d):
    """All documents as messages through a stream that is started twice, into a table."""
    base = _workspace(spark)
    messages = J.encode_messages(D.document_reviews(spark, d))
    for part in (0, 1):
        J.publish_to_files(messages.where(F.crc32(F.col("key").cast("binary")) % 2 == part), f"{base}/in")
        decoded = J.valid_messages(J.decode_messages(J.file_stream(spark, f"{base}/in"))).select(*MESSAGE_COLUMNS)
        _worked_off(T.start_sink(decoded, f"{base}/out", "decoded", f"{base}/checkpoint", interval=None))
    return as_text(with_missing(spark.read.parquet(f"{base}/out"), "is_likely_fraud"), "is_likely_fraud")


# --- monitoring -----------------------------------------------------------------------------------


@query
def monitor_totals(spark, d):
    return rounded(W.totals(D.predictions(spark, d)), "flag_rate")


@query
def monitor_recent(spark, d):
    newest = with_missing(W.recent(D.predictions(spark, d)), "prediction")
    return as_text(newest.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")), "prediction")


@query
def monitor_product_alerts(spark, d):
    return W.product_alerts(D.predictions(spark, d))


@query
def monitor_category_rate(spark, d):
    return W.category_rate(D.predictions(spark, d))


@query
def sliding_alerts(spark, d):
    alerts = W.sliding_alerts(D.predictions(spark, d), EVENT_ALERTS, keys=("product_category",))
    return as_text(rounded(alerts, "avg_fraud_prob"), "window_start", "window_end")
