import datetime as dt

import pytest
from helpers import as_dict, day, reviews
from pyspark.sql import Window
from pyspark.sql import functions as F

from review_signals.config import LabelRules, SkewRule
from review_signals.operators import labels as L
from review_signals.operators.rolling import rolling_counts
from review_signals.sources import standin as D

HOT = SkewRule(hot_rows=3, max_hot_keys=2, salts=4)


def test_low_helpful_edges(spark):
    votes = [(0, 0), (0, 5), (1, 5), (0, 4), (None, 9), (1, None), (None, None), (1, 6)]
    frame = reviews(spark, [dict(helpful_votes=h, total_votes=t) for h, t in votes])
    got = as_dict(frame.withColumn("f", L.low_helpful()), "review_id", "f")
    assert [got[f"r{i}"] for i in range(len(votes))] == [False, True, False, False, False, False, False, True]


@pytest.mark.parametrize("skew", [SkewRule(), HOT])
def test_bursts(spark, skew):
    rows = [dict(customer_id="one_day")] * 10
    rows += [dict(customer_id="two_days", review_date=day(i % 2)) for i in range(10)]
    rows += [dict(customer_id="gap", review_date=day(2 * (i % 2))) for i in range(10)]
    rows += [dict(customer_id="nine")] * 9
    rows += [dict(customer_id="no_date", review_date=None)] * 10
    labeled = L.label(reviews(spark, rows), skew=skew)
    hits = labeled.groupBy("customer_id").agg(F.sum(F.col("h2_burst_activity").cast("int")).alias("n"))
    # Over two days only the second day sees all ten; the day before a burst is not flagged.
    assert as_dict(hits, "customer_id", "n") == {"one_day": 10, "two_days": 5, "gap": 0, "nine": 0, "no_date": 10}


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin"])
def test_burst_days_ignore_clock_changes(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [dict(review_date=dt.date(2014, 11, 1 + i % 2)) for i in range(10)]
        rows += [dict(customer_id="b", review_date=dt.date(2015, 3, 28 + i % 2)) for i in range(10)]
        labeled = L.label(reviews(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert sum(r["h2_burst_activity"] for r in labeled) == 10


def test_bias_edges(spark):
    rows = [dict(customer_id="high", star_rating=4 if i < 2 else 5, review_date=day(3 * i)) for i in range(10)]
    rows += [dict(customer_id="low", star_rating=2 if i < 2 else 1, review_date=day(3 * i)) for i in range(10)]
    rows += [dict(customer_id="few", star_rating=5, review_date=day(3 * i)) for i in range(9)]
    rows += [dict(customer_id="mild", star_rating=4 if i < 3 else 5, review_date=day(3 * i)) for i in range(10)]
    hits = L.label(reviews(spark, rows)).groupBy("customer_id").agg(F.max("h3_extreme_bias").alias("f"))
    assert as_dict(hits, "customer_id", "f") == {"high": True, "low": True, "few": False, "mild": False}


def test_columns_and_row_count_are_kept(spark):
    frame = reviews(spark, [dict(customer_id=None), dict(), dict(review_date=None)])
    labeled = L.label(frame, skew=HOT)
    assert labeled.columns == [*frame.columns, *L.HEURISTICS, "is_likely_fraud"]
    assert labeled.count() == 3 and labeled.where("is_likely_fraud is null").count() == 0


def test_labels_equal_plain_windows_with_and_without_hot_keys(spark):
    """The textbook form: window functions over whole reviewers."""
    frame = D.reviews(spark, "/root/testdata/sf0.001").persist()
    whole = Window.partitionBy("customer_id")
    near = whole.orderBy(F.unix_date("review_date")).rangeBetween(-1, 0)
    expected = frame.select(
        "review_id", F.count("*").over(near).alias("rolling_24h_count"),
        F.count("*").over(whole).alias("reviewer_total_reviews"),
        F.avg("star_rating").over(whole).alias("reviewer_avg_rating"),
    ).persist()
    for skew in (SkewRule(), SkewRule(hot_rows=2, max_hot_keys=40, salts=8)):
        got = L.with_reviewer_windows(frame, skew).select(expected.columns)
        assert got.count() == expected.count()
        assert got.exceptAll(expected).count() == 0
        labeled = L.label(frame, skew=skew)
        plain = expected.select("review_id", L.burst().alias("h2"), L.extreme_bias().alias("h3"))
        mine = labeled.select("review_id", F.col("h2_burst_activity").alias("h2"), F.col("h3_extreme_bias").alias("h3"))
        assert mine.exceptAll(plain).count() == 0
    frame.unpersist()


def test_rate_gate_and_empty_table(spark):
    rows = [dict(helpful_votes=0, total_votes=5)] + [dict(customer_id=f"c{i}") for i in range(9)]
    row = L.heuristic_counts(L.label(reviews(spark, rows))).first()
    assert (row["reviews"], row["h1_count"], row["any_count"], row["any_rate"], row["in_band"]) == (10, 1, 1, 0.1, True)
    empty = L.heuristic_counts(L.label(reviews(spark, [dict()]).limit(0))).first()
    assert (empty["reviews"], empty["any_count"], empty["any_rate"], empty["in_band"]) == (0, 0, 0.0, False)


def test_threshold_is_a_parameter(spark):
    frame = reviews(spark, [dict()] * 6)
    assert L.label(frame).where("h2_burst_activity").count() == 0
    assert L.label(frame, LabelRules(burst_reviews=5)).where("h2_burst_activity").count() == 6
    swept = as_dict(L.burst_threshold_sweep(frame, [5, 7, 10]), "burst_reviews", "h2_count")
    assert swept == {5: 6, 7: 0, 10: 0}


def test_a_busy_hour_of_one_key_is_spread(spark):
    """All moments of one key in one hour: no window holds more than the slices of an hour, or a second's moments."""
    frame = spark.range(20_000).select(
        F.col("id").alias("id"), F.lit("hot").alias("k"),
        F.timestamp_micros(F.col("id") * 180_000 + F.lit(1_700_000_000_000_000 // 3_600_000_000 * 3_600_000_000)).alias("ts"))
    counted = rolling_counts(frame, "k", "ts", "id", 60, (3_600, 1), name="n")
    got = {r["id"]: r["n"] for r in counted.collect()}
    assert all(got[i] == min(i, 333) + 1 for i in range(20_000))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    orders = [line for line in plan.splitlines() if "Window [" in line and "_at" in line.split("windowspec")[-1]]
    assert orders and all("_slice0" in line and "_slice1" in line for line in orders)


@pytest.mark.parametrize("skew", [SkewRule(), SkewRule(hot_rows=2, max_hot_keys=3, salts=4)])
@pytest.mark.parametrize("slice_seconds", [(3_600,), (7,), (3_600, 1), (86_400, 3_600, 60)])
def test_rolling_counts_against_brute_force(spark, skew, slice_seconds):
    import random

    random.seed(7)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        key = random.choice(["hot", "hot", "a", "b", None])
        at = start + dt.timedelta(seconds=random.choice([0, 10, 20, 30, 60, 100, 101, 3_599, 3_600, 3_601, 7_000]))
        rows.append((i, key, at if i % 50 else None))
    frame = spark.createDataFrame(rows, "id int, k string, ts timestamp_ntz")
    got = as_dict(rolling_counts(frame, "k", "ts", "id", 60, slice_seconds, skew, "n"), "id", "n")
    for i, key, at in rows:
        if at is None or key is None:
            assert got[i] is None
            continue
        expected = sum(1 for _, k, t in rows if k == key and t and at - dt.timedelta(seconds=60) <= t <= at)
        assert got[i] == expected, (i, key, at)
    assert len(got) == 400
