"""Connected components of links between nodes, as joins: the alternating star method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_signals.llm.shared import staged


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Ties the neighbours of each node to the smallest of them: the larger ones if ``large``, else the smaller ones.

    ``edges`` has a > b. Minima are aggregated before the shuffle; the join back has an exchange on both sides.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        tied = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return tied.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node of ``links`` (columns a and b).

    Edges are written to the shared folder in each round, and rounds go on until they no longer change.
    """
    edges = staged(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (now := _print_of(edges)) != before:
        before = now
        edges = staged(_star(staged(_star(edges, large=True), "large-star"), large=False), "small-star")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
