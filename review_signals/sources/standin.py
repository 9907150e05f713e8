"""The given star-schema tables seen as review tables, so that every query can run on them.

These are plain projections and joins of whole tables. A real deployment reads its own review tables and
does not use this module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from review_signals.functions.scalars import flagged
from review_signals.operators.features import with_text_features
from review_signals.schemas import TEXT_FEATURES
from review_signals.sources.tables import read_table

# The product types of the part table, which play the categories.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
# Event values become scores by this divisor; it leaves means that are not halfway between two roundings.
EVENT_SCALE = 497
# A score from which the stand-in predictions count as flagged.
EVENT_THRESHOLD = 0.1


# The columns of the given tables. Declaring them saves reading a file footer per table and query.
TABLE_SCHEMAS = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
        props string""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", schema=TABLE_SCHEMAS[name])


def _sales(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """Lines with their part and order. The orders come last: the lines of an order then lie together, and what is grouped
    by buyer and day shrinks before it moves."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    if with_text:
        orders = with_document_text(orders, sf_dir)
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )


def _review_id():
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.concat_ws("-", *[F.col(k).cast("string") for k in keys]).alias("review_id")


def _quantity():
    return F.col("l_quantity").cast("int")


def reviews(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """One review per sales line: the buyer reviews the part.

    Every twentieth buyer only praises and every 37th only pans, which gives the bias rule its cases. ``with_text`` adds
    the text features of a document, one for all reviews of an order. Where documents share an id, a review comes once
    with each; ``first_text`` marks every review once.
    """
    votes = F.when(F.col("l_suppkey") % 10 == 0, _quantity() % 12).otherwise(0)
    stars = (
        F.when(F.col("o_custkey") % 20 == 0, 5)
        .when(F.col("o_custkey") % 37 == 0, 1)
        .otherwise(_quantity() % 5 + 1)
    )
    columns = [
        _review_id(),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("product_category"),
        stars.cast("int").alias("star_rating"),
        votes.cast("int").alias("total_votes"),
        F.floor(votes * F.round(F.col("l_discount") * 100) / 10).cast("int").alias("helpful_votes"),
        (F.col("l_returnflag") != "R").alias("verified_purchase"),
        F.col("o_orderdate").cast("date").alias("review_date"),
    ]
    rows = _sales(spark, sf_dir, with_text)
    if not with_text:
        return rows.select(*columns)
    return rows.select(*columns, *DOCUMENT_FEATURES, "first_text").withColumn("txt_sentiment", (F.col("star_rating") - 3) / 2)


DOCUMENT_FEATURES = [c for c in TEXT_FEATURES if c != "txt_sentiment"]


def with_document_text(orders: DataFrame, sf_dir: str) -> DataFrame:
    """Give each order the text features of a document, all but the sentiment, which depends on the review.

    A document is measured once, however many orders use it, and its figures meet the orders, not the more numerous lines.
    """
    documents = table(orders.sparkSession, sf_dir, "documents")
    how_many = documents.agg((F.max("doc_id") + 1).alias("n")).scalar()
    measured = with_text_features(documents.withColumn("star_rating", F.lit(0)), "text").select(
        "doc_id", *DOCUMENT_FEATURES
    )
    same_id = Window.partitionBy("doc_id").orderBy(*DOCUMENT_FEATURES)
    numbered = measured.where(F.col("doc_id").isNotNull()).withColumn("first_text", F.row_number().over(same_id) == 1)
    joined = orders.withColumn("doc_id", F.col("o_orderkey") % how_many).join(numbered, "doc_id", "left").drop("doc_id")
    return joined.withColumn("first_text", F.coalesce("first_text", F.lit(True)))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines as an untreated review file: text as bytes, dates as day numbers, gaps and wrong values."""

    def as_bytes(column):
        return column.cast("string").cast("binary")

    stars = F.when(_quantity() % 11 == 0, "x").otherwise((_quantity() % 7).cast("string"))
    headline = F.when(F.col("l_suppkey") % 9 != 0, F.concat_ws(" ", "l_returnflag", "p_brand"))
    return _sales(spark, sf_dir).select(
        as_bytes(F.lit("US")).alias("marketplace"),
        F.when(F.col("o_custkey") % 50 != 7, F.col("o_custkey")).alias("customer_id"),
        as_bytes(_review_id()).alias("review_id"),
        as_bytes(F.when(F.col("l_partkey") % 100 != 3, F.col("l_partkey"))).alias("product_id"),
        as_bytes(F.col("p_name")).alias("product_title"),
        as_bytes(F.col("p_type")).alias("product_category"),
        stars.alias("star_rating"),
        (_quantity() % 4).cast("bigint").alias("helpful_votes"),
        (_quantity() % 12).cast("bigint").alias("total_votes"),
        (F.col("l_returnflag") != "R").alias("verified_purchase"),
        as_bytes(headline).alias("review_headline"),
        as_bytes(F.when(F.col("l_linenumber") != 7, F.col("p_name"))).alias("review_body"),
        F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint").alias("review_date"),
    )


def document_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per document, with the whole text as its body and the label where there is one."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    size = F.col("n_chars").cast("int")
    return documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("source").alias("customer_id"),
        F.concat_ws("-", "lang", "source").alias("product_id"),
        F.col("lang").alias("product_category"),
        (size % 5 + 1).alias("star_rating"),
        (size % 3).alias("helpful_votes"),
        (size % 7).alias("total_votes"),
        (size % 2 == 0).alias("verified_purchase"),
        F.col("text").alias("review_body"),
        F.date_from_unix_date((F.col("doc_id") % 240 + 16_405).cast("int")).alias("review_date"),
        (F.col("toxic") == 1).alias("is_likely_fraud"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored reviews. Every fiftieth payload value has no verdict."""
    score = F.col("value") / EVENT_SCALE
    without = F.get_json_object("props", "$.k").cast("int") % 50 == 0
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("review_id"),
        F.col("user_id").cast("string").alias("product_id"),
        F.col("event_type").alias("product_category"),
        (F.floor(F.col("value")).cast("int") % 5 + 1).alias("star_rating"),
        F.when(~without, flagged(score, EVENT_THRESHOLD)).alias("prediction"),
        score.alias("fraud_probability"),
        F.col("ts").alias("timestamp"),
    )


def rule_scored(labeled: DataFrame) -> DataFrame:
    """Labelled reviews with a simple rule as their prediction: extreme and unverified."""
    suspicious = F.col("star_rating").isin(1, 5) & ~F.col("verified_purchase")
    return labeled.withColumn("prediction", F.when(suspicious, 1.0).otherwise(0.0))
