"""Histories that are kept up to date: sums per key and day, added up over batches of reviews.

A batch of new reviews is read once, down to its sums per key and day, which are kept in a partition of their own. The
history of a key follows from its sums alone, so after a batch only the keys it names are worked out again, from rows
that are as many as their days; all other rows of the lookup are carried over, and no review is read twice. A batch that
is written again (after a failure, say) replaces its own sums. Days may come in any order and in several batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_signals.operators.history import day_tallies, products_of_days, reviewers_of_days, tallies
from review_signals.sources.tables import read_table, replace_partitions

HISTORIES: dict[str, Callable[[DataFrame], DataFrame]] = {"customer_id": reviewers_of_days, "product_id": products_of_days}


def add_batch(reviews: DataFrame, store: str, key: str, batch: int) -> None:
    """Keep the sums of a batch of reviews per ``key`` and day, in place of those the store has of this batch."""
    replace_partitions(day_tallies(reviews, key).withColumn("batch", F.lit(batch).cast("long")), store, "batch", rebalance=False)


def read_batches(spark: SparkSession, store: str) -> DataFrame:
    return read_table(spark, store, hint="No batch has been added yet.")


def merged(batches: DataFrame, key: str) -> DataFrame:
    """One row per key and day, whatever batches it is spread over."""
    return batches.groupBy(key, "review_date").agg(*[F.sum(c).alias(c) for c in tallies()])


def history(batches: DataFrame, key: str) -> DataFrame:
    """The history of all keys of all batches."""
    return HISTORIES[key](merged(batches, key))


def refreshed(lookup: DataFrame | None, batches: DataFrame, key: str, batch: int) -> DataFrame:
    """The lookup after a batch: the keys of the batch worked out again, all others as they were.

    A null key is a key like others, as in the histories. In a struct it is equal to itself, so that the rows meet the keys
    of the batch by a plain join, and are summed up where they are: they move once.
    """
    held = batches.withColumn(key, F.struct(key))
    touched = held.where(F.col("batch") == batch).select(key).distinct()
    again = history(held.join(touched, key, "left_semi"), key).withColumn(key, F.col(f"{key}.{key}"))
    if lookup is None:
        return again
    kept = lookup.withColumn(key, F.struct(key)).join(touched, key, "left_anti")
    return kept.withColumn(key, F.col(f"{key}.{key}")).unionByName(again)


def compact(batches: DataFrame, store: str, key: str) -> None:
    """All batches as one, in another store: as many rows as there are keys and days, whatever the number of batches."""
    newest = batches.agg(F.max("batch")).scalar()
    replace_partitions(merged(batches, key).withColumn("batch", newest), store, "batch", rebalance=False)
