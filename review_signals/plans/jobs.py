"""The stages of the batch tier, each reading one table and writing the next, and the streaming tier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from review_signals.config import (
    SERVING_THRESHOLD,
    AlertRule,
    ForestSettings,
    LabelRules,
    SplitRule,
)
from review_signals.operators import curate as C
from review_signals.operators import features as X
from review_signals.operators import history as H
from review_signals.operators import labels as L
from review_signals.operators import metrics as Q
from review_signals.operators import model as M
from review_signals.operators import monitor as W
from review_signals.operators import profile as P
from review_signals.operators import split as S
from review_signals.operators import tallies as B
from review_signals.plans.report import training_report
from review_signals.schemas import MESSAGE_COLUMNS
from review_signals.sources import messages as J
from review_signals.sources.tables import read_table, stage, write_bucketed, write_by_category, write_plain
from review_signals.streaming import scoring as R


def inspect(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    """Column profile, category, rating and purchase counts and sample rows of raw files."""
    rows = C.text_columns(read_table(spark, raw))
    shown = ["product_category", "star_rating", "helpful_votes", "total_votes", "verified_purchase"]
    return {
        "columns": P.column_profile(rows),
        "categories": P.category_counts(rows),
        "ratings": P.rating_counts(rows),
        "verified": P.verified_counts(rows),
        "sample": P.sample_rows(rows, "review_id", shown, "review_headline"),
    }


def build_curated(spark: SparkSession, raw: str, out: str,
                  categories: Sequence[str] = C.DEFAULT_CATEGORIES) -> DataFrame:
    """Raw files to the curated table; returns the rows per category of what was written, counted in the write."""
    seen = Observation()
    # names of their own, as a category may be called anything
    cells = [F.count(F.when(F.col("product_category") == c, 1)).alias(f"n{i}") for i, c in enumerate(categories)]
    write_by_category(C.curate(read_table(spark, raw), categories), out, (seen, cells))
    rows = [(c, seen.get[f"n{i}"]) for i, c in enumerate(categories)]
    counted = spark.createDataFrame(rows, "product_category string, reviews bigint").where("reviews > 0")
    return counted.distinct().orderBy(F.desc("reviews"), "product_category")


def profile_curated(spark: SparkSession, curated: str,
                    categories: Sequence[str] = C.DEFAULT_CATEGORIES) -> dict[str, DataFrame]:
    """The descriptive queries over the curated table, of which only the chosen categories are read."""
    reviews = C.in_categories(read_table(spark, curated), categories)
    return {
        "rating_by_category": P.rating_by_category(reviews, categories),
        "helpful_ratio": P.helpful_ratio_histogram(reviews),
        "reviewer_activity": P.reviewer_activity(reviews),
        "verified_by_category": P.verified_by_category(reviews),
        "daily_velocity": P.daily_velocity(reviews),
        "top_reviewers": P.top_reviewers(reviews),
    }


def build_labels(spark: SparkSession, curated: str, out: str, rules: LabelRules = LabelRules()) -> DataFrame:
    """Curated to labelled reviews; returns positives per heuristic and whether the rate is in its band, both counted
    in the write."""
    seen, sums = Observation(), L.heuristic_sums()
    write_by_category(L.label(read_table(spark, curated), rules), out, (seen, sums))
    names = ("reviews", *[f"{n}_count" for n in L.FLAGS])
    counted = spark.createDataFrame([tuple(seen.get[n] for n in names)], ", ".join(f"{n} bigint" for n in names))
    return L.heuristic_rates(counted, rules)


def build_split(spark: SparkSession, labeled: str, train_out: str, test_out: str,
                rule: SplitRule = SplitRule()) -> DataFrame:
    """Labelled reviews to a training and a test table, by reviewer; returns the balance of both, counted in the writes."""
    rows, counted = read_table(spark, labeled), []
    sides = (("train", S.train_part(rows, rule=rule), train_out), ("test", S.test_part(rows, rule=rule), test_out))
    for name, side, out in sides:
        seen = Observation()
        write_by_category(side, out, (seen, S.side_sums()))
        counted.append((name, seen.get["reviews"], seen.get["positives"]))
    both = spark.createDataFrame(counted, "split string, reviews bigint, positives bigint")
    return S.balance(both.where("reviews > 0"))


def build_lookups(spark: SparkSession, train: str, reviewers_out: str, products_out: str, buckets: int | None = None,
                  tables: tuple[str, str] | None = None) -> None:
    """Reviewer and product history of the training table.

    With ``buckets`` both are also registered as bucketed ``tables``. Whoever reads them by these names, instead of by
    path, can join them without moving them.
    """
    if bool(buckets) != bool(tables):
        raise ValueError("bucketed lookups need a number of buckets and two table names")
    rows = read_table(spark, train)
    histories = (H.reviewer_history(rows), reviewers_out, "customer_id"), (H.product_history(rows), products_out, "product_id")
    for i, (history, path, key) in enumerate(histories):
        if buckets:
            write_bucketed(history, tables[i], path, key, buckets)
        else:
            write_plain(history, path)


def update_lookups(spark: SparkSession, reviews: str, base: str, batch: int) -> dict[str, str]:
    """Take a batch of new reviews into the sums kept below ``base``, and write both lookups as of this batch.

    Only the new reviews are read, and only the keys they name are worked out again. Batches are numbered in the order in
    which they come; the newest one can be taken in again. Returns the places of the lookups.
    """
    rows, written = read_table(spark, reviews), {}
    for name, key in (("reviewers", "customer_id"), ("products", "product_id")):
        B.add_batch(rows, f"{base}/{name}/batches", key, batch)
        batches = B.read_batches(spark, f"{base}/{name}/batches")
        earlier = batches.where(F.col("batch") < batch).agg(F.max("batch")).first()[0]
        lookup = None if earlier is None else read_table(spark, f"{base}/{name}/lookup-{earlier}")
        written[name] = f"{base}/{name}/lookup-{batch}"
        write_plain(B.refreshed(lookup, batches, key, batch), written[name])
    return written


def build_features(spark: SparkSession, labeled: str, out: str, reviewers: str | None = None,
                   products: str | None = None) -> DataFrame:
    """Labelled reviews to the feature table. A saved lookup gives its history; a missing one is made of the rows.

    For a split by reviewer, leak-free features take the products' history from the training table and the reviewers'
    from the rows themselves: no reviewer is on both sides, so their own rows are all there is of them.
    """
    saved = {
        name: read_table(spark, path) for name, path in (("reviewers", reviewers), ("products", products)) if path
    }
    write_plain(X.review_features(read_table(spark, labeled), **saved), out)
    return read_table(spark, out)


def train_model(
    spark: SparkSession,
    features: str,
    model_out: str,
    feature_set: str = "full",
    settings: ForestSettings = ForestSettings(),
    test_features: str | None = None,
    rule: SplitRule = SplitRule(),
) -> tuple[DataFrame, str]:
    """Fit and save a model, and evaluate it on reviews it has not seen.

    With ``test_features`` (made of the test reviewers, with the history of the training ones) the whole of
    ``features`` is trained on. Without it, ``features`` is split by review, which lets a reviewer be on
    both sides. Returns the metrics row and the report text. The scored hold-out is written once to the
    shared folder, as the metrics go over it several times.
    """
    table = read_table(spark, features)
    if test_features:
        train_rows, test_rows = table, read_table(spark, test_features)
    else:
        train_rows, test_rows = S.train_part(table, "review_id", rule), S.test_part(table, "review_id", rule)
    excluded = M.FEATURE_SETS[feature_set]
    model = M.train(train_rows, settings, excluded)
    M.save(model, model_out)

    held_out = Q.with_label(test_rows)
    scored = stage(
        M.score(held_out, model, settings.threshold).select(
            "review_id", "product_category", "label", "prediction", "fraud_probability"
        ),
        "scored",
    )
    metrics = M.evaluate(scored, feature_set)
    text = training_report(
        f"Suspicious-review model, {feature_set} feature set",
        table.count(), M.feature_columns(table, excluded), excluded,
        metrics, Q.confusion(scored), M.importances(model, spark),
    )
    return metrics, text


def compare_models(spark: SparkSession, features: str, models_out: str, sets: Sequence[str] = ("full", "controlled"),
                   settings: ForestSettings = ForestSettings(), test_features: str | None = None) -> DataFrame:
    """Metrics of several feature sets side by side, all trained and evaluated on the same reviews."""
    rows = [
        train_model(spark, features, f"{models_out}/{name}", name, settings, test_features)[0] for name in sets
    ]
    return M.compare(*rows)


def publish(spark: SparkSession, test: str, servers: str | None = None, topic: str | None = None,
            path: str | None = None) -> None:
    """Send the test table as messages, to a topic or to a directory of message files."""
    messages = J.encode_messages(read_table(spark, test).select(*MESSAGE_COLUMNS))
    if path:
        J.publish_to_files(messages, path)
    else:
        J.publish_to_kafka(messages, servers, topic)


def run_scoring(
    envelopes: DataFrame,
    reviewers: DataFrame,
    products: DataFrame,
    model_path: str,
    sink: str,
    checkpoints: str | None = None,
    interval: str | None = "5 seconds",
    threshold: float = SERVING_THRESHOLD,
    dead_letter_sink: str | None = None,
) -> list[StreamingQuery]:
    """Start the scoring query and, if asked for, the one that keeps broken messages."""
    scored = R.score_messages(envelopes, reviewers, products, M.load(model_path), threshold)
    at = (lambda name: f"{checkpoints}/{name}") if checkpoints else (lambda name: None)
    running = [R.start_sink(scored, sink, "predictions", at("predictions"), interval)]
    if dead_letter_sink:
        running.append(R.start_dead_letters(envelopes, dead_letter_sink, at("dead_letters"), interval))
    return running


def run_alerts(spark: SparkSession, sink: str, out: str | None = None, checkpoints: str | None = None,
               interval: str | None = "10 seconds", rule: AlertRule = AlertRule()) -> StreamingQuery:
    """Watch the predictions table for products that collect flags; to a table, or to the console."""
    alerts = R.alert_stream(R.prediction_stream(spark, sink), rule)
    checkpoint = f"{checkpoints}/alerts" if checkpoints else None
    if out:
        return R.start_sink(alerts, out, "alerts", checkpoint, interval)
    return R.start_console(alerts, "alerts", checkpoint, interval)


def run_review_console(spark: SparkSession, sink: str, checkpoints: str | None = None,
                       interval: str | None = "5 seconds") -> StreamingQuery:
    """Show predictions as they come in."""
    checkpoint = f"{checkpoints}/console" if checkpoints else None
    return R.start_console(R.prediction_stream(spark, sink), "console", checkpoint, interval)


def monitor(spark: SparkSession, sink: str) -> dict[str, DataFrame]:
    """Totals, newest predictions, product alerts and category rates of the predictions table."""
    predictions = R.read_predictions(spark, sink)
    return {
        "totals": W.totals(predictions),
        "recent": W.recent(predictions),
        "alerts": W.product_alerts(predictions),
        "categories": W.category_rate(predictions),
    }
