"""Text features of a review body. Null text counts as empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_feature_columns(body: Column, stars: Column) -> dict[str, Column]:
    """The six text features by name.

    Words are what lies between runs of white space, so empty text has one (empty) word.
    """
    text = F.coalesce(body, F.lit(""))
    length = F.length(text)
    shouted = F.regexp_count(text, F.lit(r"(?<!\S)[A-Z]{2,}(?!\S)"))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "txt_body_length": length,
        "txt_word_count": F.size(F.split(text, r"\s+")),
        "txt_exclamation_count": length - F.length(F.replace(text, F.lit("!"))),
        "txt_caps_word_count": shouted,
        "txt_caps_ratio": capitals / F.greatest(length, F.lit(1)),
        "txt_sentiment": (stars - 3) / 2,
    }
