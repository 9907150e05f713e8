"""The streaming tier on message files, worked off with availableNow, against the batch functions."""

import datetime as dt
import json
import os

import pytest
from helpers import reviews
from pyspark.sql import functions as F

from review_signals.config import AlertRule, ForestSettings
from review_signals.operators import features as X
from review_signals.operators import history as H
from review_signals.operators import labels as L
from review_signals.operators import model as M
from review_signals.operators import monitor as W
from review_signals.plans import jobs
from review_signals.schemas import PREDICTION_COLUMNS, PREDICTION_SCHEMA
from review_signals.sources import messages as J
from review_signals.streaming import scoring as R

START = dt.datetime(2024, 1, 1)


def put_messages(spark, path, messages, at=START):
    rows = [(json.dumps(m).encode() if isinstance(m, dict) else m.encode(), at) for m in messages]
    spark.createDataFrame(rows, J.ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def message(i, **fields):
    return {"review_id": f"r{i}", "customer_id": f"c{i % 3}", "product_id": f"p{i % 2}", "product_category": "Books",
            "star_rating": 1 + i % 5, "review_body": "GOOD stuff! " * i, "review_date": "2015-03-01", **fields}


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("model"))
    rows = reviews(spark, [dict(customer_id=f"c{i % 3}", product_id=f"p{i % 4}", star_rating=1 + i % 5,
                                total_votes=(i % 2) * 7, review_body="GOOD! " * (i % 9)) for i in range(60)])
    labeled = L.label(rows)
    people, goods = H.reviewer_history(labeled).where("customer_id <> 'c2'"), H.product_history(labeled)
    for frame, name in ((people, "people"), (goods, "goods")):
        frame.write.parquet(f"{base}/{name}")
    model = M.train(X.review_features(labeled), ForestSettings(trees=3, depth=3))
    M.save(model, f"{base}/model")
    return base


def start(spark, trained, source, work, **more):
    lookups = spark.read.parquet(f"{trained}/people"), spark.read.parquet(f"{trained}/goods")
    for query in jobs.run_scoring(J.file_stream(spark, source), *lookups, f"{trained}/model", f"{work}/predictions",
                                  f"{work}/checkpoints", interval=None, **more):
        query.awaitTermination(120)
        assert query.exception() is None


def test_stream_equals_batch_and_restarts_without_repeats(spark, trained, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path)
    put_messages(spark, source, [message(i) for i in range(10)] + ['{"review_id": "bro'])
    start(spark, trained, source, work, dead_letter_sink=f"{work}/dead")
    put_messages(spark, source, [message(i) for i in range(10, 15)])
    start(spark, trained, source, work, dead_letter_sink=f"{work}/dead")
    start(spark, trained, source, work, dead_letter_sink=f"{work}/dead")

    got = R.read_predictions(spark, f"{work}/predictions")
    assert got.columns == list(PREDICTION_COLUMNS)
    lookups = spark.read.parquet(f"{trained}/people"), spark.read.parquet(f"{trained}/goods")
    expected = R.score_messages(spark.read.parquet(source), *lookups, M.load(f"{trained}/model"))
    assert got.count() == 15 and got.exceptAll(expected).count() == 0
    assert [r["malformed"] for r in spark.read.parquet(f"{work}/dead").collect()] == ['{"review_id": "bro']
    # Reviewer c2 is unknown to the lookup and scored all the same.
    assert got.where("review_id = 'r2' and fraud_probability is not null").count() == 1


def test_monitor_over_missing_and_present_sink(spark, trained, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path)
    assert tuple(jobs.monitor(spark, f"{work}/predictions")["totals"].first()) == (0, 0, 0.0)
    put_messages(spark, source, [message(i) for i in range(6)])
    start(spark, trained, source, work, threshold=0.0)
    seen = jobs.monitor(spark, f"{work}/predictions")
    assert tuple(seen["totals"].first()) == (6, 6, 1.0)
    assert sorted(r["fraud_count"] for r in seen["alerts"].collect()) == [3, 3]
    assert seen["recent"].count() == 6


def test_uncommitted_files_of_the_sink_stay_hidden(spark, trained, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path)
    put_messages(spark, source, [message(i) for i in range(4)])
    start(spark, trained, source, work)
    stray = spark.createDataFrame([("x", "p", "Books", 5, 1.0, 1.0, START)], PREDICTION_SCHEMA)
    stray.coalesce(1).write.parquet(f"{work}/stray")
    for name in os.listdir(f"{work}/stray"):
        if name.endswith(".parquet"):
            with open(f"{work}/stray/{name}", "rb") as file, open(f"{work}/predictions/{name}", "wb") as copy:
                copy.write(file.read())
    open(f"{work}/predictions/part-empty.parquet", "wb").close()
    assert R.read_predictions(spark, f"{work}/predictions").count() == 4


def put_predictions(spark, path, rows):
    full = [(f"r{n}", p, "Books", 5, y, s, START + dt.timedelta(minutes=m)) for n, (p, y, s, m) in enumerate(rows)]
    spark.createDataFrame(full, PREDICTION_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run_alerts(spark, source, work):
    query = jobs.run_alerts(spark, source, f"{work}/alerts", f"{work}/checkpoints", interval=None)
    query.awaitTermination(120)
    assert query.exception() is None
    path = f"{work}/alerts"
    found = spark.read.parquet(path) if any(f.endswith(".parquet") for f in os.listdir(path)) else None
    return sorted((r["window_start"], r["product_id"], r["fraud_count"]) for r in found.collect()) if found else []


def test_alerts_wait_for_the_watermark_and_drop_late_rows(spark, tmp_path):
    source, work = str(tmp_path / "predictions"), str(tmp_path)
    put_predictions(spark, source, [("a", 1.0, 0.9, 1), ("a", 1.0, 0.9, 2), ("a", 1.0, 0.9, 3), ("a", 0.0, 0.1, 3),
                                    ("b", 1.0, 0.9, 3)])
    assert run_alerts(spark, source, work) == []
    # Far later rows move the watermark past both windows of the burst.
    put_predictions(spark, source, [("z", 1.0, 0.9, 60)])
    first = [(START - dt.timedelta(minutes=5), "a", 3), (START, "a", 3)]
    assert run_alerts(spark, source, work) == first
    # Too late: these belong to windows that have been closed.
    put_predictions(spark, source, [("b", 1.0, 0.9, 3), ("b", 1.0, 0.9, 4), ("b", 1.0, 0.9, 4)])
    put_predictions(spark, source, [("z", 1.0, 0.9, 120)])
    assert run_alerts(spark, source, work) == first


def test_closed_windows_equal_the_batch_query(spark, tmp_path):
    """Events as predictions: all windows but the last open ones, as a stream and as a table."""
    from review_signals.sources import standin as D

    source, work = str(tmp_path / "predictions"), str(tmp_path)
    rule = AlertRule(window="6 hours", slide="3 hours", watermark="1 hour")
    events = D.predictions(spark, "/root/testdata/sf0.001").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    events.select(*PREDICTION_COLUMNS).coalesce(1).write.parquet(source)
    stream = W.sliding_alerts(R.prediction_stream(spark, source), rule, keys=("product_category",))
    query = R.start_sink(stream, f"{work}/alerts", "closed", f"{work}/checkpoints", interval=None)
    query.awaitTermination(120)
    got = spark.read.parquet(f"{work}/alerts")
    last = events.where("prediction = 1").agg(F.max("timestamp")).first()[0] - dt.timedelta(hours=1)
    table = W.sliding_alerts(events, rule, keys=("product_category",))
    expected = table.where(F.col("window_end") <= F.lit(last))
    pick = ["window_start", "window_end", "product_category", "fraud_count"]
    assert got.count() == expected.count() > 0
    assert got.select(pick).exceptAll(expected.select(pick)).count() == 0


def test_console_and_processing_time_triggers(spark, trained, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path)
    put_messages(spark, source, [message(i) for i in range(3)])
    start(spark, trained, source, work)
    query = jobs.run_review_console(spark, f"{work}/predictions", f"{work}/checkpoints", interval="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
        assert sum(progress["numInputRows"] for progress in query.recentProgress) == 3
    finally:
        query.stop()


def test_published_messages_come_back(spark, trained, tmp_path):
    rows = L.label(reviews(spark, [dict(customer_id=f"c{i}") for i in range(5)]))
    from review_signals.sources.tables import write_by_category

    write_by_category(rows, str(tmp_path / "test"))
    jobs.publish(spark, str(tmp_path / "test"), path=str(tmp_path / "in"))
    start(spark, trained, str(tmp_path / "in"), str(tmp_path))
    assert R.read_predictions(spark, str(tmp_path / "predictions")).count() == 5


def test_kafka_needs_its_connector(spark):
    """Without the connector the error says so; the options are passed on."""
    with pytest.raises(Exception, match="(?i)kafka"):
        J.kafka_stream(spark, "localhost:9092", "reviews")
