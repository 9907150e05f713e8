"""Weak-supervision labels: three heuristics, combined by OR."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_signals.config import LabelRules, SkewRule
from review_signals.functions.scalars import as_int, helpful_ratio, share
from review_signals.operators.rolling import day_number, reviewer_days
from review_signals.operators.skew import attach

HEURISTICS = ("h1_low_helpful", "h2_burst_activity", "h3_extreme_bias")
FLAGS = {"h1": HEURISTICS[0], "h2": HEURISTICS[1], "h3": HEURISTICS[2], "any": "is_likely_fraud"}


def low_helpful(rules: LabelRules = LabelRules()) -> Column:
    """Enough votes, and too few of them helpful; unknown votes give False."""
    ratio = helpful_ratio(F.col("helpful_votes"), F.col("total_votes"))
    test = (F.col("total_votes") >= rules.min_votes) & (ratio < rules.max_helpful_ratio)
    return F.coalesce(test, F.lit(False))


def burst(rules: LabelRules = LabelRules()) -> Column:
    return F.col("rolling_24h_count") >= rules.burst_reviews


def extreme_bias(rules: LabelRules = LabelRules()) -> Column:
    mean = F.col("reviewer_avg_rating")
    one_sided = (mean >= rules.bias_high_mean) | (mean <= rules.bias_low_mean)
    return (F.col("reviewer_total_reviews") >= rules.bias_min_reviews) & one_sided


def with_reviewer_windows(reviews: DataFrame, skew: SkewRule = SkewRule()) -> DataFrame:
    """Every review with the rolling count, total and mean rating of its reviewer."""
    rows = reviews.withColumn("_day", day_number())
    stats = reviewer_days(reviews)
    joined = attach(rows, stats, ["customer_id", "_day"], salt_by=["review_id"], size="day_reviews", rule=skew)
    return joined.drop("_day", "day_reviews")


def label(reviews: DataFrame, rules: LabelRules = LabelRules(), skew: SkewRule = SkewRule(),
          reviewers: DataFrame | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Reviews with the three heuristics and ``is_likely_fraud``.

    Reviews travel once, to meet the reviewer-days; only days on which a rule fires are sent against them. ``reviewers``,
    figures with one row per customer_id, are brought to the reviews on the same way: what fires is then sent as one row
    per reviewer, with the days of bursts beside the figures. ``counted`` are the reviews that the rules count, if some of
    ``reviews`` are there more than once.
    """
    days = reviewer_days(reviews if counted is None else counted).withColumns({"h2_burst_activity": burst(rules), "h3_extreme_bias": extreme_bias(rules)})
    rows = reviews.withColumns({"_day": day_number(), "h1_low_helpful": low_helpful(rules)})
    if reviewers is None:
        fired = days.select("customer_id", "_day", "day_reviews", "h2_burst_activity", "h3_extreme_bias")
        # A day above the hot size is kept even if no rule fires, so that its rows are still spread.
        quiet = ~F.coalesce(F.col("h2_burst_activity") | F.col("h3_extreme_bias"), F.lit(False))
        fired = fired.where(~quiet | (F.col("day_reviews") >= skew.hot_rows))
        flags = attach(rows, fired, ["customer_id", "_day"], salt_by=["review_id"], size="day_reviews", rule=skew)
        figures = []
    else:
        # one row per reviewer, from the same exchange as the windows: at most as many days as the calendar has
        fired = days.groupBy("customer_id").agg(
            F.max("reviewer_total_reviews").alias("_reviews"),
            F.collect_list(F.when(F.col("h2_burst_activity"), F.col("_day"))).alias("_burst_days"),
            F.max("h3_extreme_bias").alias("h3_extreme_bias"),
        )
        known = fired.join(reviewers, "customer_id", "left")
        joined = attach(rows, known, ["customer_id"], salt_by=["review_id"], size="_reviews", rule=skew)
        flags = joined.withColumn("h2_burst_activity", F.array_contains("_burst_days", F.col("_day")))
        figures = [c for c in reviewers.columns if c != "customer_id"]
    flags = flags.withColumns({c: F.coalesce(c, F.lit(False)) for c in HEURISTICS[1:]})
    any_rule = F.col(HEURISTICS[0]) | F.col(HEURISTICS[1]) | F.col(HEURISTICS[2])
    return flags.select(*reviews.columns, *figures, *HEURISTICS, any_rule.alias("is_likely_fraud"))


def heuristic_counts(labeled: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """Positives per heuristic, their rates and whether the labelling is usable; one row, one pass."""
    return heuristic_rates(labeled.agg(*heuristic_sums()), rules)


def heuristic_sums() -> list[Column]:
    """The aggregates behind :func:`heuristic_counts`, for a pass over labelled rows or for a write that counts them."""
    sums = [F.coalesce(F.sum(as_int(F.col(c))), F.lit(0)).alias(f"{n}_count") for n, c in FLAGS.items()]
    return [F.count(F.lit(1)).alias("reviews"), *sums]


def heuristic_rates(counted: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    rates = {f"{n}_rate": share(F.col(f"{n}_count"), F.col("reviews")) for n in FLAGS}
    in_band = F.col("any_rate").between(rules.min_positive_rate, rules.max_positive_rate)
    return counted.withColumns(rates).withColumn("in_band", in_band)


def burst_threshold_sweep(reviews: DataFrame, thresholds: list[int], rules: LabelRules = LabelRules(),
                          skew: SkewRule = SkewRule()) -> DataFrame:
    """Burst and overall positives for several burst thresholds, from one pass over the reviews."""
    windows = with_reviewer_windows(reviews, skew)
    count = F.col("rolling_24h_count")
    base = F.coalesce(low_helpful(rules) | extreme_bias(rules), F.lit(False))
    # Reviews collapse to (rolling count capped at the largest threshold, other rule) before they multiply.
    reduced = windows.groupBy(
        F.least(F.coalesce(count, F.lit(0)), F.lit(max(thresholds)).cast("bigint")).alias("_count"),
        base.alias("_other"),
    ).agg(F.count("*").alias("_n"))
    per_threshold = reduced.withColumn("burst_reviews", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    hit = F.col("_count") >= F.col("burst_reviews")
    return (
        per_threshold.groupBy("burst_reviews")
        .agg(
            F.sum("_n").alias("reviews"),
            F.sum(F.when(hit, F.col("_n")).otherwise(0)).alias("h2_count"),
            F.sum(F.when(hit | F.col("_other"), F.col("_n")).otherwise(0)).alias("any_count"),
        )
        .withColumns(
            {
                "h2_rate": share(F.col("h2_count"), F.col("reviews")),
                "any_rate": share(F.col("any_count"), F.col("reviews")),
            }
        )
    )
