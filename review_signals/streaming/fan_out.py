"""One pass over a stream of messages, with several outputs.

Each batch of messages is decoded once and scored once. What can be scored goes to ``predictions``, what cannot to
``dead_letters``, and the flags of each sliding window and product, counted, to ``hits``. All three are tables in
partitions by batch, and a batch that runs again replaces its own partition in each of them. Last of all a row about the
batch goes to ``batches``, so readers, which take only batches that have one, never see part of a batch.

The row holds what was counted while the tables were written: messages, scored and broken ones, flags.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from review_signals.config import AlertRule
from review_signals.operators.monitor import is_flagged
from review_signals.schemas import PREDICTION_COLUMNS
from review_signals.sources.messages import dead_letters, decode_messages, valid_messages
from review_signals.sources.tables import read_table

#: From decoded messages to rows with ``prediction`` and ``fraud_probability``.
Scorer = Callable[[DataFrame], DataFrame]


def window_hits(predictions: DataFrame, rule: AlertRule, *keys: str) -> DataFrame:
    """Flags per window and key, as sums that add up over batches."""
    grouped = predictions.where(is_flagged()).groupBy(F.window("timestamp", rule.window, rule.slide), *keys)
    counted = grouped.agg(F.count(F.lit(1)).alias("fraud_count"), F.sum("fraud_probability").alias("sum_fraud_prob"))
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "fraud_count", "sum_fraud_prob")


def _write(rows: DataFrame, base: str, table: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{base}/{table}/batch={batch}")


def write_batch(envelopes: DataFrame, batch: int, base: str, score: Scorer, rule: AlertRule = AlertRule(),
                keys: tuple[str, ...] = ("product_id", "product_category")) -> None:
    """All outputs of one batch, in place of what an earlier run of it has left."""
    spark = envelopes.sparkSession
    decoded = decode_messages(envelopes).persist(StorageLevel.MEMORY_AND_DISK)
    counts, flags = Observation(), Observation()
    try:
        broken = F.count(F.when(F.col("malformed").isNotNull(), 1))
        seen = decoded.observe(counts, F.count(F.lit(1)).alias("messages"), broken.alias("broken"))
        _write(dead_letters(seen), base, "dead_letters", batch)
        scored = score(valid_messages(decoded)).select(*PREDICTION_COLUMNS)
        flagged = F.count(F.when(is_flagged(), 1))
        _write(scored.observe(flags, F.count(F.lit(1)).alias("scored"), flagged.alias("flagged")), base, "predictions", batch)
    finally:
        decoded.unpersist()
    # read again, so that the scorer runs once
    written = spark.read.schema(scored.schema).parquet(f"{base}/predictions/batch={batch}")
    _write(window_hits(written, rule, *keys), base, "hits", batch)
    row = [(counts.get["messages"], counts.get["broken"], flags.get["scored"], flags.get["flagged"])]
    _write(spark.createDataFrame(row, "messages long, broken long, scored long, flagged long").coalesce(1), base, "batches", batch)


def start_fan_out(envelopes: DataFrame, base: str, score: Scorer, checkpoint: str, interval: str | None = "5 seconds",
                  rule: AlertRule = AlertRule(), keys: tuple[str, ...] = ("product_id", "product_category")) -> StreamingQuery:
    """Work a stream of envelopes off into the tables below ``base``; without ``interval``, what is there, and stop."""
    writer = envelopes.writeStream.queryName("fan_out").option("checkpointLocation", checkpoint).foreachBatch(
        lambda rows, batch: write_batch(rows, batch, base, score, rule, keys))
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def read_batches(spark: SparkSession, base: str) -> DataFrame:
    """What was counted, a row per batch that is complete."""
    return read_table(spark, f"{base}/batches", hint="No batch has been worked off yet.")


def read_complete(spark: SparkSession, base: str, table: str) -> DataFrame:
    """``predictions``, ``dead_letters`` or ``hits`` of all complete batches."""
    complete = read_batches(spark, base).select("batch")
    return read_table(spark, f"{base}/{table}").join(complete, "batch", "left_semi").drop("batch")


def alerts(hits: DataFrame, rule: AlertRule = AlertRule(), keys: tuple[str, ...] = ("product_id", "product_category")) -> DataFrame:
    """Keys that have collected enough flags within a window, over all batches."""
    summed = hits.groupBy("window_start", "window_end", *keys).agg(
        F.sum("fraud_count").alias("fraud_count"), F.sum("sum_fraud_prob").alias("_sum"))
    return summed.where(F.col("fraud_count") >= rule.min_hits).select(
        "window_start", "window_end", *keys, "fraud_count", (F.col("_sum") / F.col("fraud_count")).alias("avg_fraud_prob"))
