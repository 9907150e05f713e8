"""What each batch of a running query did, kept as a table.

A listener writes one small JSON file per batch: rows read, rows held as state, groups dropped as late, the watermark and
the time taken. Files appear under their final name only when they are whole. A batch that runs again after a failure
writes a second file, and :func:`read_progress` keeps the newest one of each query and batch.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from review_signals.sources.tables import MissingInput, read_table

PROGRESS_SCHEMA = """query_id string, run_id string, name string, batch bigint, at string, input_rows bigint,
    state_rows bigint, late_groups bigint, watermark string, millis bigint"""


class ProgressLog(StreamingQueryListener):
    """Writes the progress of all queries of a session below ``path``; use it as a context manager.

    ``late_groups`` counts what the state operators dropped for being behind the watermark. Spark counts there after it
    has combined the rows of a key, so an aggregation counts a late window and key once per batch, however many late rows
    it has. Queries without state have 0 there and in ``state_rows``, and no watermark.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._ended, self._failures = {}, []
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._spark.streams.removeListener(self)

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def await_end(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait for a query that has stopped until its last batch is written; what went wrong in writing is raised here."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of query {query.runId} was reported within {seconds} s")
        if self._failures:
            raise RuntimeError("progress of a batch could not be written") from self._failures[0]

    def _write(self, row: dict) -> None:
        hadoop = self._spark._jvm.org.apache.hadoop.fs
        name = f"{row['query_id']}-{row['batch']}-{row['run_id']}.json"
        hidden, final = hadoop.Path(f"{self._path}/.{name}"), hadoop.Path(f"{self._path}/{name}")
        files = final.getFileSystem(self._spark._jsc.hadoopConfiguration())
        out = files.create(hidden, True)
        try:
            out.write(bytearray((json.dumps(row) + "\n").encode()))
        finally:
            out.close()
        files.delete(final, False)
        if not files.rename(hidden, final):
            raise OSError(f"{final.toString()} could not be written")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        done = event.progress
        row = {
            "query_id": str(done.id), "run_id": str(done.runId), "name": done.name, "batch": done.batchId,
            "at": done.timestamp, "input_rows": done.numInputRows,
            "state_rows": sum(s.numRowsTotal for s in done.stateOperators),
            "late_groups": sum(s.numRowsDroppedByWatermark for s in done.stateOperators),
            "watermark": done.eventTime.get("watermark"), "millis": done.batchDuration,
        }
        try:
            self._write(row)
        except Exception as error:  # an error here would be logged and lost: the bus swallows it
            self._failures.append(error)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch, from its newest run; empty as long as nothing has been reported."""
    try:
        rows = read_table(spark, path, schema=PROGRESS_SCHEMA, format="json")
    except MissingInput:
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    newest = Window.partitionBy("query_id", "batch").orderBy(F.desc("at"), F.desc("run_id"))
    return rows.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")


def progress_by_query(progress: DataFrame) -> DataFrame:
    """Batches, rows read, late groups and time of each query, with the state and the watermark after its last batch."""
    def last(column: str):
        return F.max_by(column, "batch").alias(column)

    return progress.groupBy("query_id").agg(
        last("name"), F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("late_groups").alias("late_groups"), last("state_rows"), last("watermark"), F.sum("millis").alias("millis"))
