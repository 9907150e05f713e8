"""One pass over messages with several outputs: whole, once each, also after a failure in between."""

import json

import pytest
from pyspark.sql import functions as F

from review_signals.config import AlertRule
from review_signals.operators.monitor import sliding_alerts
from review_signals.plans.queries import _forget_commit
from review_signals.sources.messages import file_stream
from review_signals.streaming import fan_out as O

RULE = AlertRule(window="2 hours", slide="1 hour", min_hits=2)


def scorer(rows):
    score = F.col("star_rating") / 5
    return rows.withColumn("fraud_probability", score).withColumn("prediction", (score >= 0.8).cast("double"))


def message(i, stars, product="p", **more):
    return json.dumps({"review_id": f"r{i}", "product_id": product, "product_category": "Books", "star_rating": stars, **more})


def send(spark, path, texts, minute=0):
    rows = [(text.encode(), minute + i) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "value binary, minute int")
    frame.select("value", F.timestamp_seconds(F.col("minute") * 60).alias("timestamp")).write.mode("append").parquet(path)


def work_off(spark, base, score=scorer):
    query = O.start_fan_out(file_stream(spark, f"{base}/in"), f"{base}/out", score, f"{base}/checkpoint", None, RULE)
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def ids(frame):
    return sorted(r.review_id for r in frame.collect())


def test_outputs_and_counts(spark, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/in", [message(0, 5), "{broken", message(1, 4), message(2, 1), '{"star_rating": 3}'])
    work_off(spark, base)
    send(spark, f"{base}/in", [message(3, 5), message(4, 2)], minute=30)
    work_off(spark, base)
    out = f"{base}/out"
    assert ids(O.read_complete(spark, out, "predictions")) == ["r0", "r1", "r2", "r3", "r4"]
    assert sorted(r.malformed for r in O.read_complete(spark, out, "dead_letters").collect()) == ['{"star_rating": 3}', "{broken"]
    assert sorted((r.batch, r.messages, r.broken, r.scored, r.flagged) for r in O.read_batches(spark, out).collect()) == [(0, 5, 2, 3, 2), (1, 2, 0, 2, 1)]


def test_alerts_equal_those_of_all_rows_at_once(spark, tmp_path):
    base = str(tmp_path)
    for part in range(3):
        send(spark, f"{base}/in", [message(10 * part + i, 1 + (part + i) % 5, f"p{i % 2}") for i in range(10)], minute=50 * part)
        work_off(spark, base)
    rows = O.read_complete(spark, f"{base}/out", "predictions")
    once = sliding_alerts(rows, RULE).select("window_start", "product_id", "fraud_count", F.round("avg_fraud_prob", 9))
    ours = O.alerts(O.read_complete(spark, f"{base}/out", "hits"), RULE).select("window_start", "product_id", "fraud_count", F.round("avg_fraud_prob", 9))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, once.collect())) != []


def test_a_batch_that_failed_between_its_outputs_is_made_whole(spark, tmp_path):
    """The scorer fails after the broken messages were kept: readers don't see the batch; the next start makes it whole."""
    base, out = str(tmp_path), f"{tmp_path}/out"
    send(spark, f"{base}/in", [message(0, 5)])
    work_off(spark, base)
    send(spark, f"{base}/in", [message(1, 5), "{broken"])

    def failing(rows):
        return scorer(rows).withColumn("prediction", F.raise_error(F.lit("lost")).cast("double"))

    with pytest.raises(Exception, match="lost"):
        work_off(spark, base, failing)
    assert spark.read.parquet(f"{out}/dead_letters").count() == 1
    assert O.read_complete(spark, out, "dead_letters").count() == 0 and ids(O.read_complete(spark, out, "predictions")) == ["r0"]
    work_off(spark, base)
    assert O.read_complete(spark, out, "dead_letters").count() == 1 and ids(O.read_complete(spark, out, "predictions")) == ["r0", "r1"]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    base, out = str(tmp_path), f"{tmp_path}/out"
    for part in range(2):
        send(spark, f"{base}/in", [message(2 * part + i, 5) for i in range(2)] + ["{broken"])
        work_off(spark, base)
    before = {table: sorted(map(str, O.read_complete(spark, out, table).collect())) for table in ("predictions", "dead_letters", "hits")}
    _forget_commit(spark, f"{base}/checkpoint", batch=1)
    work_off(spark, base)
    assert {table: sorted(map(str, O.read_complete(spark, out, table).collect())) for table in before} == before
    assert O.read_batches(spark, out).count() == 2


def test_each_message_is_scored_once(spark, tmp_path):
    base, scored = str(tmp_path), spark.sparkContext.accumulator(0)
    send(spark, f"{base}/in", [message(i, 5) for i in range(20)])

    @F.udf("double")
    def counting(stars):
        scored.add(1)
        return stars / 5

    def slow(rows):
        return rows.withColumn("fraud_probability", counting("star_rating")).withColumn("prediction", F.lit(1.0))

    work_off(spark, base, slow)
    assert scored.value == 20
