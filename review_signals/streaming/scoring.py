"""Scoring a stream of review messages.

One query decodes, enriches and scores every message once and appends to the predictions table, whose
commit log makes the output exactly-once. Console output and alerts are queries over that table, so the
model runs once however many of them there are.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from review_signals.config import SERVING_THRESHOLD, AlertRule, CrossRules
from review_signals.operators import model as M
from review_signals.operators.features import enrich
from review_signals.operators.monitor import sliding_alerts
from review_signals.schemas import PREDICTION_COLUMNS, PREDICTION_SCHEMA
from review_signals.session import shared_dir
from review_signals.sources.messages import dead_letters, decode_messages, valid_messages
from review_signals.sources.tables import MissingInput, read_table


def score_messages(
    envelopes: DataFrame,
    reviewers: DataFrame,
    products: DataFrame,
    model: PipelineModel,
    threshold: float = SERVING_THRESHOLD,
    rules: CrossRules = CrossRules(),
) -> DataFrame:
    """Predictions for a stream, or a table, of message envelopes."""
    incoming = valid_messages(decode_messages(envelopes))
    scored = M.score(enrich(incoming, reviewers, products, rules), model, threshold)
    return scored.select(*PREDICTION_COLUMNS)


def _checkpoint(spark: SparkSession, name: str, location: str | None) -> str:
    return location or f"{shared_dir(spark)}/streams/{name}"


def _start(rows: DataFrame, name: str, checkpoint: str | None, interval: str | None):
    """Append writer with a checkpoint; ``interval`` None works off what is there and stops."""
    writer = (
        rows.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", _checkpoint(rows.sparkSession, name, checkpoint))
    )
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def start_sink(rows: DataFrame, path: str, name: str = "predictions", checkpoint: str | None = None,
               interval: str | None = "5 seconds") -> StreamingQuery:
    """Append a stream to a Parquet table."""
    return _start(rows, name, checkpoint, interval).format("parquet").option("path", path).start()


def start_console(rows: DataFrame, name: str, checkpoint: str | None = None, interval: str | None = "5 seconds",
                  num_rows: int = 20) -> StreamingQuery:
    """Show the first rows of each batch on the driver's console."""
    writer = _start(rows, name, checkpoint, interval).format("console")
    return writer.option("truncate", False).option("numRows", num_rows).start()


def start_dead_letters(envelopes: DataFrame, path: str, checkpoint: str | None = None,
                       interval: str | None = "10 seconds") -> StreamingQuery:
    """Keep messages that could not be decoded."""
    return start_sink(dead_letters(decode_messages(envelopes)), path, "dead_letters", checkpoint, interval)


def prediction_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1_000) -> DataFrame:
    """The predictions table as a stream: only committed files are seen, each of them once."""
    return (
        spark.readStream.schema(PREDICTION_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(path)
    )


def alert_stream(predictions: DataFrame, rule: AlertRule = AlertRule()) -> DataFrame:
    """Products that collect flags, one row per closed window."""
    return sliding_alerts(predictions, rule)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The whole predictions table; empty, with its columns, as long as nothing has been scored."""
    try:
        return read_table(spark, path, schema=PREDICTION_SCHEMA)
    except MissingInput:
        return spark.createDataFrame([], PREDICTION_SCHEMA)


def await_any(spark: SparkSession, timeout_seconds: int | None = None) -> None:
    """Wait until one of the running queries ends; a failed one raises its error here."""
    if timeout_seconds is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout_seconds)
