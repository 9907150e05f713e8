import pytest
from pyspark.sql import functions as F

from review_signals.config import SkewRule
from review_signals.operators.skew import attach, key_sizes

RULE = SkewRule(hot_rows=100, max_hot_keys=3, salts=16)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows(spark):
    """A third of all rows has one key; some rows have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))
    )
    return spark.range(6_000).select(F.col("id").alias("row_id"), key.alias("k"))


def stats(frame):
    return frame.groupBy("k").agg(F.count("*").alias("n"), F.max("row_id").alias("top"))


@pytest.mark.parametrize("from_sizes", [False, True])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_equals_a_plain_join(spark, no_broadcast, from_sizes, how):
    frame = rows(spark)
    figures = stats(frame).where("k <> 'k7'")
    source = {"sizes": key_sizes(frame, ["k"])} if from_sizes else {"size": "n"}
    got = attach(frame, figures, ["k"], ["row_id"], how=how, rule=RULE, **source)
    expected = frame.join(figures, "k", how).select(*frame.columns, "n", "top")
    assert got.columns == expected.columns
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_without_figures(spark, how):
    frame = rows(spark)
    figures = stats(frame).where("k <> 'hot'")
    got = attach(frame, figures, ["k"], ["row_id"], sizes=key_sizes(frame, ["k"]), how=how, rule=RULE)
    assert got.count() == frame.join(figures, "k", how).count()
    assert got.where("k = 'hot' and n is not null").count() == 0


def test_hot_rows_spread_over_the_shuffle(spark, no_broadcast):
    frame = rows(spark)
    got = attach(frame, stats(frame), ["k"], ["row_id"], size="n", rule=RULE)
    # The figures are used, or Spark would leave out the join.
    counted = [F.count("*").alias("n"), F.sum("top").alias("used")]

    def largest_task(joined):
        tasks = joined.groupBy(F.spark_partition_id()).agg(*counted)
        return tasks.where("used > 0").agg(F.max("n")).first()[0]

    per_task = largest_task(got)
    plain_task = largest_task(frame.join(stats(frame).hint("merge"), "k", "left"))
    assert plain_task >= 2_000
    assert per_task < 1_600


def test_salt_is_part_of_the_shuffle_key_and_figures_are_computed_once(spark, no_broadcast):
    frame = rows(spark)
    got = attach(frame, stats(frame), ["k"], ["row_id"], size="n", rule=RULE)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert any("hashpartitioning(k#" in line and "_salt#" in line for line in plan.splitlines())
    assert "ReusedExchange" in plan


def test_hot_list_is_bounded_by_its_rule(spark):
    """All keys have enough rows; only the one that holds its share of them is hot, and none is cut off."""
    frame = rows(spark)
    got = attach(frame, stats(frame), ["k"], ["row_id"], size="n", rule=SkewRule(hot_rows=1, max_hot_keys=4, salts=4))
    assert "Limit" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where("n is null and k is not null").count() == 0


def test_a_key_below_the_bound_is_left_to_adaptive_execution(spark, no_broadcast):
    """A large key that is not hot by the rule takes the ordinary join, whose partitions Spark may split."""
    frame, huge = rows(spark), SkewRule(hot_rows=2_001)
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        wide = frame.withColumn("pad", F.sha2(F.col("row_id").cast("string"), 256))
        figures = spark.createDataFrame([(r["k"], r["n"]) for r in stats(frame).collect() if r["k"]], "k string, n long")
        got = attach(wide, figures.hint("merge"), ["k"], ["row_id"], size="n", rule=huge)
        assert got.where("n is not null").count() == frame.where("k is not null").count()
    finally:
        for key in settings:
            spark.conf.unset(key)
