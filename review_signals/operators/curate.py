"""From raw review rows to the curated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_signals.functions.scalars import date_from_epoch_days
from review_signals.schemas import RAW_TEXT_COLUMNS

DEFAULT_CATEGORIES = ("Wireless", "Books", "Apparel")


def text_columns(raw: DataFrame) -> DataFrame:
    """Text that some writers store as bare bytes, as strings."""
    present = [c for c in RAW_TEXT_COLUMNS if c in raw.columns]
    return raw.withColumns({c: F.col(c).cast("string") for c in present})


def in_categories(raw: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Category filter in the type the column is stored in, so that it reaches the Parquet scan."""
    stored = raw.schema["product_category"].dataType
    if isinstance(stored, T.BinaryType):
        return raw.where(F.col("product_category").isin([F.lit(c.encode()) for c in categories]))
    return raw.where(F.col("product_category").isin(list(categories)))


def curate(raw: DataFrame, categories: Sequence[str] = DEFAULT_CATEGORIES) -> DataFrame:
    """Typed, valid reviews of the chosen categories.

    Values that cannot be converted become null; rows without reviewer, product or a rating of 1 to 5 go.
    """
    typed = text_columns(in_categories(raw, categories)).withColumns(
        {
            "customer_id": F.col("customer_id").cast("string"),
            "star_rating": F.col("star_rating").try_cast("int"),
            "helpful_votes": F.col("helpful_votes").try_cast("int"),
            "total_votes": F.col("total_votes").try_cast("int"),
            "review_date": date_from_epoch_days(F.col("review_date")),
            "review_headline": F.coalesce(F.col("review_headline").cast("string"), F.lit("")),
            "review_body": F.coalesce(F.col("review_body").cast("string"), F.lit("")),
        }
    )
    return typed.where(
        F.col("customer_id").isNotNull()
        & F.col("product_id").isNotNull()
        & F.col("star_rating").between(1, 5)
    )
