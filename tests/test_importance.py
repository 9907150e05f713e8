"""Importance of features by permutation, against a plain loop."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from review_signals.config import ForestSettings
from review_signals.operators import importance as I
from review_signals.operators import model as M

SCHEMA = "review_id string, label double, a double, b double, c double"
FEATURES = ("a", "b", "c")


def rule(rows):
    return rows.withColumn("fraud_probability", F.round(F.coalesce("a", F.lit(0.5)) + 0.1 * F.coalesce("b", F.lit(0.5)), 6))


def table(spark, n=400, seed=1):
    dice, rows = random.Random(seed), []
    for i in range(n):
        label = float(dice.random() < 0.3)
        rows.append((f"r{i}", label, None if i % 17 == 0 else label * 0.5 + dice.random(), dice.random(), dice.random()))
    return spark.createDataFrame(rows, SCHEMA)


def area(rows):
    """Share of pairs of a positive and a negative that the score orders rightly; ties count half."""
    good, bad = [r["fraud_probability"] for r in rows if r["label"]], [r["fraud_probability"] for r in rows if not r["label"]]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_equals_scoring_each_permuted_table(spark):
    rows = table(spark)
    got = {r["feature"]: r for r in I.permutation_importance(rows, FEATURES, rule, blocks=3).collect()}
    paired = I.with_neighbour(rows, FEATURES, "review_id", 3)
    whole = area(rule(rows).collect())
    for feature in FEATURES:
        expected = area(rule(paired.withColumn(feature, F.col(f"_other.{feature}"))).collect())
        assert got[feature]["whole_auc"] == pytest.approx(whole)
        assert got[feature]["permuted_auc"] == pytest.approx(expected)
        assert got[feature]["importance"] == pytest.approx(whole - expected)
    assert got["c"]["importance"] == 0.0 and got["a"]["importance"] > 0.1
    assert {(r["reviews"], r["positives"]) for r in got.values()} == {(400, int(rows.agg(F.sum("label")).first()[0]))}


def test_neighbours_are_a_permutation_that_the_layout_does_not_change(spark):
    rows = table(spark)
    a = I.with_neighbour(rows.repartition(7), FEATURES, "review_id", 5)
    b = I.with_neighbour(rows.repartition(2, "a"), FEATURES, "review_id", 5)
    assert a.exceptAll(b).count() == 0
    assert a.select("_other.*").exceptAll(rows.select(*FEATURES)).count() == 0 and a.count() == 400
    moved = a.where(~F.col("_other.b").eqNullSafe(F.col("b"))).count()
    assert moved == 400


def test_odd_rows(spark):
    rows = table(spark, 40)
    empty = I.permutation_importance(rows.where("false"), FEATURES, rule)
    assert empty.count() == 0
    one_class = I.permutation_importance(rows.where("label = 1"), FEATURES, rule).collect()
    assert len(one_class) == 3 and all(r["importance"] is None for r in one_class)
    repeated = rows.unionAll(rows).withColumn("review_id", F.when(F.col("b") > 0.5, F.col("review_id")))
    assert I.with_neighbour(repeated, FEATURES, "review_id", 4).count() == 80
    assert {r["reviews"] for r in I.permutation_importance(repeated, FEATURES, rule, blocks=4).collect()} == {80}
    single = I.permutation_importance(rows, FEATURES, rule, blocks=1_000_000).collect()
    assert all(r["importance"] == 0.0 for r in single)


def test_a_trained_model_is_scored_in_one_pass(spark):
    rows = table(spark, 600).na.fill(0.5)
    model = M.train(rows.withColumn("is_likely_fraud", F.col("label") == 1.0), ForestSettings(trees=5, depth=3))
    names = M.training_stages(FEATURES, ForestSettings())[0].getInputCols()
    assert list(names) == list(FEATURES)
    found = I.permutation_importance(rows, FEATURES, lambda r: M.score(r, model), blocks=4)
    by_feature = {r["feature"]: r["importance"] for r in found.collect()}
    assert max(by_feature, key=by_feature.get) == "a" and by_feature["a"] > 0.1


def test_a_fresh_model_scores_beside_observed_rows(spark):
    """Models hold no session: one that observes rows can't be sent to tasks."""
    rows, seen = table(spark, 60).na.fill(0.5), Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    model = M.train(rows.withColumn("is_likely_fraud", F.col("label") == 1.0), ForestSettings(trees=2, depth=2))
    assert M.score(rows, model).where("fraud_probability is not null").count() == seen.get["n"] == 60
