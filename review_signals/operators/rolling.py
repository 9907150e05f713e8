"""Rolling counts per key that stay distributed when one key holds a large part of the rows.

A window function puts a whole key into one task. Here rows are first aggregated to one row per key and
point in time, and windows only run over groups whose size the calendar bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_signals.config import SkewRule
from review_signals.functions.scalars import MICROS_PER_SECOND, epoch_micros
from review_signals.operators.skew import attach

# Stands for a missing date; far from every real day, so it never shares a frame with one.
NO_DAY = -1_000_000_000


def day_number(date_column: str = "review_date"):
    return F.coalesce(F.unix_date(F.col(date_column)).cast("bigint"), F.lit(NO_DAY).cast("bigint"))


def reviewer_days(reviews: DataFrame) -> DataFrame:
    """One row per reviewer and day: counts of that day, of that day and the day before, and overall.

    The grouping pre-aggregates before its shuffle. Both windows then run over at most one row per
    calendar day and reviewer, and share one exchange.
    """
    days = reviews.groupBy("customer_id", day_number().alias("_day")).agg(
        F.count("*").alias("day_reviews"),
        F.count("star_rating").alias("_rated"),
        F.sum("star_rating").alias("_stars"),
    )
    whole = Window.partitionBy("customer_id")
    two_days = whole.orderBy("_day").rangeBetween(-1, 0)
    return days.select(
        "customer_id",
        "_day",
        "day_reviews",
        F.sum("day_reviews").over(two_days).alias("rolling_24h_count"),
        F.sum("day_reviews").over(whole).alias("reviewer_total_reviews"),
        F.try_divide(F.sum("_stars").over(whole), F.sum("_rated").over(whole)).alias("reviewer_avg_rating"),
    )


def rolling_counts(
    rows: DataFrame,
    key: str,
    ts: str,
    row_id: str,
    horizon_seconds: int = 86_400,
    slice_seconds: Sequence[int] = (3_600, 1),
    rule: SkewRule = SkewRule(),
    name: str = "rolling_count",
) -> DataFrame:
    """Rows of the same key in [ts - horizon, ts], both ends included, added to every row.

    Every row counts +1 from its own time on and -1 just after the horizon has passed; the rolling count is
    the running total of these steps. The running total is taken per key and finest time slice. What earlier
    slices contribute enters as one carry row at the start of the slice. Carries are computed level by level from
    the sums of slices: of ``slice_seconds``, each divides the one before it, and a window over slices stays inside
    one slice of the level above. So a busy hour of one key spreads over its seconds, and no join is needed.
    """
    for above, below in zip(slice_seconds, slice_seconds[1:]):
        if above % below:
            raise ValueError("each slice must divide the one before it")
    at = epoch_micros(F.col(ts), rows.schema[ts].dataType)
    arrivals = rows.where(F.col(ts).isNotNull()).groupBy(key, at.alias("_at")).agg(F.count("*").alias("_n"))
    steps = arrivals.select(
        key,
        F.inline(
            F.array(
                F.struct("_at", F.col("_n").alias("_step"), F.col("_n").alias("_n")),
                F.struct(
                    (F.col("_at") + horizon_seconds * MICROS_PER_SECOND + 1).alias("_at"),
                    (-F.col("_n")).alias("_step"),
                    F.lit(0).cast("bigint").alias("_n"),
                ),
            )
        ),
    )
    levels = [f"_slice{i}" for i in range(len(slice_seconds))]
    steps = steps.withColumns({
        level: F.floor(F.col("_at") / (seconds * MICROS_PER_SECOND))
        for level, seconds in zip(levels, slice_seconds)
    })
    carries = None
    for depth, seconds in enumerate(slice_seconds):
        upper, level = levels[:depth], levels[depth]
        slices = steps.groupBy(key, *upper, level).agg(F.sum("_step").alias("_sum"))
        if carries is not None:
            # What the level above hands down comes before the first of its slices, as a slice without a number.
            handed = carries.select(key, *upper, F.lit(None).cast("bigint").alias(level), F.col("_step").alias("_sum"))
            slices = slices.unionByName(handed)
        order = F.col(level).asc_nulls_first()
        earlier = Window.partitionBy(key, *upper).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        carries = slices.select(
            key, *upper, level,
            (F.col(level) * seconds * MICROS_PER_SECOND).alias("_at"),
            F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_step"),
            F.lit(0).cast("bigint").alias("_n"),
        ).where(F.col(level).isNotNull())
    # RANGE frame: everything of the same moment counts at once, whichever row of it comes first.
    running = Window.partitionBy(key, *levels).orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    moments = (
        steps.unionByName(carries)
        .select(key, "_at", "_n", F.sum("_step").over(running).alias(name))
        .where("_n > 0")
    )
    stamped = rows.withColumn("_at", at)
    return attach(stamped, moments, [key, "_at"], salt_by=[row_id], size="_n", rule=rule).drop("_at", "_n")
