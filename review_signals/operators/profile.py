"""Descriptive queries over the curated reviews.

All of them aggregate before they shuffle. Windows and sorts over a result run on a handful of rows, or
on one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_signals.functions.scalars import as_int, helpful_ratio, ratio_bin, share
from review_signals.operators.split import key_sample


def column_profile(rows: DataFrame) -> DataFrame:
    """One row per column: position, type, rows and nulls of the whole table."""
    fields = rows.schema.fields
    counted = rows.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(f.name)).alias(f"_{i}") for i, f in enumerate(fields)]
    )
    described = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("_rows").alias("row_count"),
                (F.col("_rows") - F.col(f"_{i}")).alias("null_count"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counted.select(F.inline(described))


def sample_rows(rows: DataFrame, order_by: str, columns: Sequence[str], headline: str, limit: int = 5,
                width: int = 60) -> DataFrame:
    """The first rows by key, with the headline cut to a readable width."""
    shown = rows.select(order_by, *columns, F.substring(headline, 1, width).alias("headline"))
    return shown.orderBy(order_by).limit(limit)


def counts_by(rows: DataFrame, *keys: str, name: str = "reviews") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def category_counts(reviews: DataFrame) -> DataFrame:
    return counts_by(reviews, "product_category").orderBy(F.desc("reviews"), "product_category")


def rating_counts(reviews: DataFrame) -> DataFrame:
    return counts_by(reviews, "star_rating").orderBy("star_rating")


def verified_counts(reviews: DataFrame) -> DataFrame:
    return counts_by(reviews, "verified_purchase").orderBy("verified_purchase")


def rating_by_category(reviews: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Ratings down, categories across. The categories are named, which saves a pass to find them."""
    return _wide_counts(reviews, "star_rating", "product_category", {c: c.lower() for c in categories})


def verified_by_category(reviews: DataFrame) -> DataFrame:
    return _wide_counts(reviews, "product_category", "verified_purchase", {False: "unverified", True: "verified"})


def _wide_counts(rows: DataFrame, down: str, across: str, names: dict) -> DataFrame:
    cells = [F.count(F.when(F.col(across) == value, 1)).alias(name) for value, name in names.items()]
    return rows.groupBy(down).agg(*cells).orderBy(down)


def helpful_ratio_histogram(reviews: DataFrame, bins: int = 20, fraction: float | None = None) -> DataFrame:
    """Histogram of helpful/total over the reviews with a vote: exact, or of a repeatable sample of them."""
    if fraction is not None:
        reviews = key_sample(reviews, "review_id", fraction)
    voted = reviews.where((F.col("total_votes") >= 1) & F.col("helpful_votes").isNotNull())
    binned = voted.groupBy(ratio_bin(F.col("helpful_votes"), F.col("total_votes"), bins).alias("bin")).agg(
        F.count("*").alias("reviews")
    )
    return binned.select(
        "bin", (F.col("bin") / bins).alias("low"), ((F.col("bin") + 1) / bins).alias("high"), "reviews"
    ).orderBy("bin")


def helpful_extremes(reviews: DataFrame) -> DataFrame:
    """Share of voted reviews that nobody, or everybody, found helpful."""
    ratio = helpful_ratio(F.col("helpful_votes"), F.col("total_votes"))
    return reviews.where(F.col("total_votes") >= 1).agg(
        F.count("*").alias("voted_reviews"),
        F.avg(as_int(ratio == 0)).alias("share_none_helpful"),
        F.avg(as_int(ratio == 1)).alias("share_all_helpful"),
    )


def reviewer_activity(reviews: DataFrame, limit: int = 50) -> DataFrame:
    """How many reviewers wrote how many reviews, smallest numbers first."""
    per_reviewer = counts_by(reviews, "customer_id", name="n_reviews")
    return counts_by(per_reviewer, "n_reviews", name="reviewers").orderBy("n_reviews").limit(limit)


def heavy_reviewers(reviews: DataFrame, above: Sequence[int] = (10, 49)) -> DataFrame:
    """Reviewers beyond each number of reviews, and their share of all reviews."""
    per_reviewer = counts_by(reviews, "customer_id", name="_n")
    sizes = per_reviewer.groupBy("_n").agg(F.count("*").alias("_reviewers"))
    per_limit = sizes.withColumn("more_than", F.explode(F.array(*[F.lit(a) for a in above])))
    heavy = F.col("_n") > F.col("more_than")
    written = F.sum(F.when(heavy, F.col("_n") * F.col("_reviewers")).otherwise(0))
    return per_limit.groupBy("more_than").agg(
        F.sum(F.when(heavy, F.col("_reviewers")).otherwise(0)).alias("reviewers"),
        written.alias("reviews"),
        share(written, F.sum(F.col("_n") * F.col("_reviewers"))).alias("review_share"),
    )


def daily_velocity(reviews: DataFrame) -> DataFrame:
    return counts_by(reviews, "review_date").orderBy("review_date")


def weekday_velocity(reviews: DataFrame) -> DataFrame:
    """Days seen, total and mean volume per weekday (0 is Monday)."""
    daily = counts_by(reviews.where(F.col("review_date").isNotNull()), "review_date")
    return daily.groupBy(F.weekday("review_date").alias("weekday")).agg(
        F.count("*").alias("days"), F.sum("reviews").alias("reviews"), F.avg("reviews").alias("mean_per_day")
    )


def velocity_spikes(reviews: DataFrame, days_before: int = 7, factor: float = 1.35) -> DataFrame:
    """Days whose volume reaches the factor times the mean of the calendar days before; one row per day is compared.

    A day without reviews counts as 0. Days that lie less than ``days_before`` after the first one have no full baseline
    and are never spikes, nor are days after nothing but empty ones.
    """
    daily = counts_by(reviews.where(F.col("review_date").isNotNull()), "review_date")
    number = F.unix_date("review_date").cast("bigint")
    before = Window.partitionBy().orderBy(number).rangeBetween(-days_before, -1)
    first = F.min(number).over(Window.partitionBy())
    compared = daily.select(
        "*", (F.sum("reviews").over(before) / days_before).alias("baseline"), (number - first).alias("_age")
    )
    spikes = compared.where((F.col("_age") >= days_before) & (F.col("reviews") >= F.col("baseline") * factor))
    return spikes.withColumn("ratio", F.col("reviews") / F.col("baseline")).drop("_age")


def top_reviewers(reviews: DataFrame, limit: int = 20) -> DataFrame:
    """The most active reviewers with rank, and reviews per active day (first to last review, inclusive)."""
    per_reviewer = reviews.groupBy("customer_id").agg(
        F.count("*").alias("reviews"),
        (F.datediff(F.max("review_date"), F.min("review_date")) + 1).alias("span_days"),
    )
    best = per_reviewer.orderBy(F.desc("reviews"), "customer_id").limit(limit)
    order = Window.partitionBy().orderBy(F.desc("reviews"), "customer_id")
    return best.select(
        F.row_number().over(order).alias("rank"),
        "customer_id",
        "reviews",
        "span_days",
        F.try_divide(F.col("reviews"), F.col("span_days")).alias("per_day"),
    )


def top_reviewers_in_period(reviews: DataFrame, limit: int = 20) -> DataFrame:
    """The most active reviewers, with their mean per day over the period the whole table covers."""
    per_reviewer = reviews.groupBy("customer_id").agg(
        F.count("*").alias("reviews"), F.min("review_date").alias("_first"), F.max("review_date").alias("_last")
    )
    # Two aggregates of one grouping; the period is a single row, read as a scalar.
    period = per_reviewer.agg((F.datediff(F.max("_last"), F.min("_first")) + 1).alias("days")).scalar()
    best = per_reviewer.orderBy(F.desc("reviews"), "customer_id").limit(limit)
    order = Window.partitionBy().orderBy(F.desc("reviews"), "customer_id")
    return best.select(
        F.row_number().over(order).alias("rank"),
        "customer_id",
        "reviews",
        F.try_divide(F.col("reviews"), period).alias("per_day_of_period"),
    )


def verified_share(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("product_category").agg(
        F.count("*").alias("reviews"), F.avg(as_int(F.col("verified_purchase"))).alias("verified_share")
    )


def rating_share(reviews: DataFrame) -> DataFrame:
    """Share of every rating in all reviews; the total is taken over the few rating rows."""
    counted = counts_by(reviews, "star_rating")
    everything = F.sum("reviews").over(Window.partitionBy())
    return counted.select("star_rating", "reviews", share(F.col("reviews"), everything).alias("review_share"))


def extreme_by_verified(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("verified_purchase").agg(
        F.count("*").alias("reviews"), F.avg(as_int(F.col("star_rating").isin(1, 5))).alias("extreme_share")
    )


def entity_counts(reviews: DataFrame, exact: bool = True, error: float = 0.01) -> DataFrame:
    """Distinct reviewers and products: exact, or as sketches of bounded error in a single small pass."""
    if exact:
        reviewers, products = F.count_distinct("customer_id"), F.count_distinct("product_id")
    else:
        reviewers = F.approx_count_distinct("customer_id", error)
        products = F.approx_count_distinct("product_id", error)
    return reviews.agg(
        F.count("*").alias("reviews"), reviewers.alias("reviewers"), products.alias("products")
    )


# Distinct counts that add up: a sketch per group, small whatever the group holds; 2^16 registers err by 0.4 percent (one
# standard error).
SKETCH_SIZE = 16


def entity_sketches(reviews: DataFrame, *keys: str) -> DataFrame:
    """Reviews per group, and sketches of their reviewers and products, to be kept and merged later."""
    return reviews.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.hll_sketch_agg("customer_id", F.lit(SKETCH_SIZE)).alias("reviewers"),
        F.hll_sketch_agg("product_id", F.lit(SKETCH_SIZE)).alias("products"),
    )


def merged_entities(sketches: DataFrame, *keys: str) -> DataFrame:
    """Reviews, reviewers and products of coarser groups, from kept sketches alone."""
    summed = [F.sum("reviews").alias("reviews")]
    summed += [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("reviewers", "products")]
    return sketches.groupBy(*keys).agg(*summed) if keys else sketches.agg(*summed)


def file_profile(rows: DataFrame, *columns: str) -> DataFrame:
    """Per ``file`` its rows, and for each column how many of them have no value."""
    return rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns])
