"""The log of what a stream's batches did."""

import datetime as dt

import pytest

from review_signals.config import AlertRule
from review_signals.operators.monitor import sliding_alerts
from review_signals.schemas import PREDICTION_SCHEMA
from review_signals.streaming import progress as G
from review_signals.streaming import scoring as T

START = dt.datetime(2024, 1, 1)
RULE = AlertRule(window="10 minutes", slide="10 minutes", watermark="10 minutes", min_hits=1)


def put(spark, path, minutes):
    rows = [(f"r{m}-{n}", "p", "Books", 5, 1.0, 0.9, START + dt.timedelta(minutes=m)) for n, m in enumerate(minutes)]
    spark.createDataFrame(rows, PREDICTION_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def work_off(spark, log, rows, out, checkpoint, name="alerts"):
    query = T.start_sink(rows, out, name, checkpoint, interval=None)
    query.awaitTermination(120)
    assert query.exception() is None
    log.await_end(query)


def test_late_windows_state_and_watermark(spark, tmp_path):
    base = str(tmp_path)
    with G.ProgressLog(spark, f"{base}/log") as log:
        for minutes in ([1, 2, 15, 61], [3, 3, 3, 16, 55, 62]):
            put(spark, f"{base}/in", minutes)
            alerts = sliding_alerts(T.prediction_stream(spark, f"{base}/in"), RULE)
            work_off(spark, log, alerts, f"{base}/out", f"{base}/checkpoint")
    seen = G.progress_by_query(G.read_progress(spark, f"{base}/log")).collect()
    assert len(seen) == 1 and seen[0]["name"] == "alerts"
    # the watermark is at minute 51 when the second part comes: the windows from 0 and 10 are closed, that from 50 isn't
    assert (seen[0]["late_groups"], seen[0]["state_rows"]) == (2, 2)
    assert seen[0]["watermark"] == "2024-01-01T00:52:00.000Z" and seen[0]["input_rows"] == 10


def test_streams_without_state_and_several_queries(spark, tmp_path):
    base = str(tmp_path)
    assert G.read_progress(spark, f"{base}/log").columns == [f.split()[0] for f in G.PROGRESS_SCHEMA.split(",")]
    put(spark, f"{base}/in", range(5))
    with G.ProgressLog(spark, f"{base}/log") as log:
        for name in ("one", "two"):
            work_off(spark, log, T.prediction_stream(spark, f"{base}/in"), f"{base}/{name}", f"{base}/c-{name}", name)
    rows = {r["name"]: r for r in G.progress_by_query(G.read_progress(spark, f"{base}/log")).collect()}
    assert set(rows) == {"one", "two"}
    assert all((r["input_rows"], r["state_rows"], r["late_groups"], r["watermark"]) == (5, 0, 0, None) for r in rows.values())
    # a log that is closed takes no more
    put(spark, f"{base}/in", range(5, 7))
    T.start_sink(T.prediction_stream(spark, f"{base}/in"), f"{base}/one", "one", f"{base}/c-one", interval=None).awaitTermination(120)
    assert G.read_progress(spark, f"{base}/log").count() == 2


def test_the_newest_run_of_a_batch_counts(spark, tmp_path):
    log = G.ProgressLog(spark, str(tmp_path))
    first = dict(query_id="q", run_id="r1", name="n", batch=4, at="2024-01-01T00:00:00.000Z", input_rows=3, state_rows=0,
                 late_groups=0, watermark=None, millis=1)
    log._write(first)
    log._write({**first, "run_id": "r0", "at": "2024-01-01T00:00:09.000Z", "input_rows": 7})
    log._write(first)
    assert [(r["run_id"], r["input_rows"]) for r in G.read_progress(spark, str(tmp_path)).collect()] == [("r0", 7)]


def test_a_log_that_cannot_be_written_is_an_error(spark, tmp_path):
    (tmp_path / "log").write_text("a file where the folder should be")
    put(spark, f"{tmp_path}/in", range(2))
    with G.ProgressLog(spark, f"{tmp_path}/log") as log:
        with pytest.raises(RuntimeError, match="could not be written"):
            work_off(spark, log, T.prediction_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/c")
