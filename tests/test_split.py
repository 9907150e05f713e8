from helpers import as_dict, reviews
from pyspark.sql import functions as F

from review_signals.config import SplitRule
from review_signals.operators import labels as L
from review_signals.operators import split as S


def keys(spark, n=1_000):
    return spark.range(n).selectExpr("cast(id as string) as customer_id", "cast(id as string) as review_id")


def test_split_ignores_the_partition_layout(spark):
    sides = [
        {r["customer_id"] for r in S.train_part(keys(spark).repartition(n)).collect()} for n in (3, 7)
    ]
    assert sides[0] == sides[1]
    assert 650 < len(sides[0]) < 750


def test_parts_are_disjoint_and_complete(spark):
    rows = keys(spark).union(spark.createDataFrame([(None, "x")], "customer_id string, review_id string"))
    train, test = S.train_part(rows), S.test_part(rows)
    assert train.select("customer_id").intersect(test.select("customer_id")).count() == 0
    assert train.unionByName(test).exceptAll(rows).count() == 0
    assert train.count() + test.count() == 1_001


def test_seed_and_share_are_parameters(spark):
    other = S.train_part(keys(spark), rule=SplitRule(seed=7)).count()
    half = S.train_part(keys(spark), rule=SplitRule(train_percent=50))
    assert other != S.train_part(keys(spark)).count()
    assert 450 < half.count() < 550
    assert half.join(S.train_part(keys(spark)), "customer_id", "left_anti").count() == 0


def test_balance(spark):
    rows = L.label(reviews(spark, [dict(customer_id=str(i), total_votes=9 * (i % 2)) for i in range(100)]))
    got = as_dict(S.split_balance(rows), "split", "reviews", "row_share", "positives", "positive_rate")
    assert sum(v[0] for v in got.values()) == 100 and sum(v[2] for v in got.values()) == 50
    assert abs(sum(v[1] for v in got.values()) - 1) < 1e-12


def test_restrict_to_keys_ignores_repeated_and_unknown_keys(spark):
    wanted = spark.createDataFrame([("1",), ("1",), ("2",), ("nobody",), (None,)], "customer_id string")
    rows = keys(spark).union(keys(spark))
    got = S.restrict_to_keys(rows, wanted, "customer_id")
    assert as_dict(got.groupBy("customer_id").agg(F.count("*").alias("n")), "customer_id", "n") == {"1": 2, "2": 2}


def test_sample_is_repeatable_and_close_to_its_share(spark):
    rows = keys(spark, 20_000)
    first = {r["review_id"] for r in S.key_sample(rows, "review_id", 0.01).collect()}
    second = {r["review_id"] for r in S.key_sample(rows.repartition(5), "review_id", 0.01).collect()}
    assert first == second and 140 < len(first) < 260
    assert S.key_sample(rows, "review_id", 1.0).count() == 20_000


def test_small_shares_are_not_rounded(spark):
    rows = keys(spark, 200_000)
    assert 3 <= S.key_sample(rows, "review_id", 0.00005).count() <= 20
    assert 15 <= S.key_sample(rows, "review_id", 0.00015).count() <= 50


def test_row_sample_is_close_to_its_share(spark):
    assert 140 < S.row_sample(keys(spark, 20_000), 0.01).count() < 260


def test_split_adds_no_shuffle(spark):
    plan = S.train_part(keys(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
