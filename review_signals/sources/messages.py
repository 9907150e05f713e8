"""The review message: a JSON object in a binary ``value`` with an ingestion ``timestamp`` beside it.

Encoding and decoding are plain column work, so the same functions serve a Kafka topic, a directory of
message files and a static table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_signals.schemas import MESSAGE_COLUMNS, MESSAGE_SCHEMA

ENVELOPE_SCHEMA = "value binary, timestamp timestamp"


def encode_messages(reviews: DataFrame) -> DataFrame:
    """One JSON message per review: eleven fields, ISO dates, nulls written out.

    ``key`` is the review id, so that the reviews of one busy product spread over all topic partitions.
    """
    payload = F.to_json(F.struct(*MESSAGE_COLUMNS), {"ignoreNullFields": "false"})
    return reviews.select(F.col("review_id").alias("key"), payload.alias("value"))


def decode_messages(envelopes: DataFrame) -> DataFrame:
    """Flatten the payload to columns, keeping ``timestamp`` and the text of broken messages.

    ``malformed`` holds the raw text where it is no JSON object of the expected types, or has no review id.
    """
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = envelopes.select(
        F.from_json(text, f"{MESSAGE_SCHEMA}, _corrupt string", options).alias("data"),
        text.alias("_text"),
        "timestamp",
    )
    broken = F.col("data").isNull() | F.col("data._corrupt").isNotNull() | F.col("data.review_id").isNull()
    return parsed.select(
        *[f"data.{c}" for c in MESSAGE_COLUMNS],
        "timestamp",
        F.when(broken, F.coalesce(F.col("_text"), F.lit(""))).alias("malformed"),
    )


def valid_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("malformed").isNull()).drop("malformed")


def dead_letters(decoded: DataFrame) -> DataFrame:
    """The messages that cannot be scored, for a table of their own."""
    return decoded.where(F.col("malformed").isNotNull()).select("timestamp", "malformed")


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_per_trigger: int = 1_000_000,
) -> DataFrame:
    """Unbounded topic. Needs the spark-sql-kafka connector of the Spark version in use on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .load()
        .select("value", "timestamp")
    )


def publish_to_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send all messages from the executors, in batches; needs the same connector."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1_000) -> DataFrame:
    """Directory of Parquet envelopes as a stream: the topic's stand-in where there is no broker."""
    return (
        spark.readStream.schema(ENVELOPE_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(path)
    )


def publish_to_files(messages: DataFrame, path: str) -> None:
    """Append messages as envelope files, stamped with the time of publishing."""
    (
        messages.select(F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))
        .write.mode("append")
        .parquet(path)
    )
