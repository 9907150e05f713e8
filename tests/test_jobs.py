"""All batch stages one after the other on raw files, through the command line."""

import os

import pytest
from pyspark.sql import functions as F

from review_signals.__main__ import parser, run
from review_signals.config import ForestSettings
from review_signals.plans import jobs
from review_signals.schemas import FEATURE_COLUMNS
from review_signals.sources import standin as D

CATEGORIES = ["MEDIUM", "PROMO", "SMALL"]


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("jobs"))
    raw = D.raw_reviews(spark, "/root/testdata/sf0.001")
    for i, part in enumerate(raw.randomSplit([0.5, 0.5], 1)):
        part.coalesce(1).write.parquet(f"{base}/raw/reviews_{i}.parquet")

    def cli(*arguments):
        run(spark, parser().parse_args(list(arguments)))

    cli("inspect", f"{base}/raw/reviews_*.parquet")
    cli("curate", f"{base}/raw/reviews_*.parquet", f"{base}/curated", "--categories", *CATEGORIES)
    cli("profile", f"{base}/curated", "--categories", *CATEGORIES)
    cli("label", f"{base}/curated", f"{base}/labeled", "--burst", "3")
    cli("split", f"{base}/labeled", f"{base}/train", f"{base}/test")
    cli("lookups", f"{base}/train", f"{base}/reviewers", f"{base}/products")
    history = ["--products", f"{base}/products"]
    cli("features", f"{base}/labeled", f"{base}/features")
    cli("features", f"{base}/train", f"{base}/train_features", *history)
    cli("features", f"{base}/test", f"{base}/test_features", *history)
    cli("train", f"{base}/train_features", f"{base}/model", "--trees", "3", "--threshold", "0.05",
        "--test-features", f"{base}/test_features", "--report", f"{base}/report.md")
    return base


def test_stages_agree(spark, base):
    curated = spark.read.parquet(f"{base}/curated")
    labeled, features = spark.read.parquet(f"{base}/labeled"), spark.read.parquet(f"{base}/features")
    train, test = spark.read.parquet(f"{base}/train"), spark.read.parquet(f"{base}/test")
    assert curated.count() == labeled.count() == features.count() == train.count() + test.count() > 0
    assert {r[0] for r in curated.select("product_category").distinct().collect()} == set(CATEGORIES)
    assert train.select("customer_id").intersect(test.select("customer_id")).count() == 0
    assert features.columns[3:] == list(FEATURE_COLUMNS)
    assert os.path.isdir(f"{base}/curated/product_category=PROMO")


def test_each_side_has_its_own_reviewers_and_the_products_of_training(spark, base):
    features = spark.read.parquet(f"{base}/test_features").join(
        spark.read.parquet(f"{base}/test").select("review_id", "customer_id", "product_id"), "review_id")
    own = spark.read.parquet(f"{base}/test").groupBy("customer_id").count()
    assert features.join(own, "customer_id").where("rev_total_reviews <> count").count() == 0
    goods = spark.read.parquet(f"{base}/products")
    assert features.join(goods, "product_id").where("prod_total_reviews <> ph_total_reviews").count() == 0
    assert features.join(goods, "product_id", "left_anti").where("prod_total_reviews <> 0").count() == 0


def test_tables_have_few_files_per_category(base):
    for name in ("curated", "labeled", "train", "test"):
        for part in os.listdir(f"{base}/{name}"):
            if part.startswith("product_category="):
                assert sum(f.endswith(".parquet") for f in os.listdir(f"{base}/{name}/{part}")) == 1


def test_profile_and_monitor_write_whole_results(spark, base, tmp_path):
    run(spark, parser().parse_args(["profile", f"{base}/curated", "--categories", *CATEGORIES, "--out", str(tmp_path)]))
    days = spark.read.parquet(f"{base}/curated").select("review_date").distinct().count()
    assert spark.read.parquet(f"{tmp_path}/daily_velocity").count() == days > 50


def test_scoring_from_the_command_line(spark, base, tmp_path):
    run(spark, parser().parse_args(["publish", f"{base}/test", "--path", f"{tmp_path}/in"]))
    arguments = ["score", f"{base}/model", f"{tmp_path}/sink", "--reviewers", f"{base}/reviewers", "--products", f"{base}/products",
                 "--path", f"{tmp_path}/in", "--checkpoints", f"{tmp_path}/c", "--interval", "once", "--threshold", "0.0"]
    run(spark, parser().parse_args(arguments))
    run(spark, parser().parse_args(arguments))
    scored = spark.read.parquet(f"{tmp_path}/sink")
    assert scored.count() == spark.read.parquet(f"{base}/test").count() == scored.where("prediction = 1.0").count()


def test_report_holds_the_results(base):
    text = open(f"{base}/report.md", encoding="utf-8").read()
    for part in ("full feature set", "ROC AUC", "Confusion matrix", "| Features | 20 |", "rev_total_reviews"):
        assert part in text


def test_models_side_by_side(spark, base):
    table = jobs.compare_models(spark, f"{base}/features", f"{base}/models", settings=ForestSettings(trees=2, depth=3))
    assert table.columns == ["metric", "controlled", "full"]
    assert table.where(F.col("full").isNull()).count() == 0


def test_bucketed_lookups_keep_their_rows(spark, base, tmp_path):
    people, goods = str(tmp_path / "people_b"), str(tmp_path / "goods_b")
    jobs.build_lookups(spark, f"{base}/train", people, goods, buckets=4, tables=("people_b", "goods_b"))
    try:
        rows = spark.read.parquet(f"{base}/train").select("customer_id", "star_rating")
        plans = []
        for lookup in (spark.table("people_b"), spark.read.parquet(people)):
            joined = rows.hint("merge").join(lookup, "customer_id", "left")
            plans.append(joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        assert plans == [1, 2]
        assert spark.table("people_b").count() == spark.read.parquet(f"{base}/reviewers").count()
        assert spark.table("goods_b").exceptAll(spark.read.parquet(f"{base}/products")).count() == 0
    finally:
        for name in ("people_b", "goods_b"):
            spark.sql(f"drop table if exists {name}")


def test_counts_of_a_write_are_those_of_the_table(spark, base, tmp_path):
    """What the jobs return is counted in the write: the same as reading the table again, without reading it."""
    from review_signals.operators import labels as L
    from review_signals.operators import profile as P
    from review_signals.operators import split as S

    chosen = [*CATEGORIES, "no such category"]
    counted = jobs.build_curated(spark, f"{base}/raw/reviews_*.parquet", f"{tmp_path}/curated", chosen)
    again = spark.read.parquet(f"{tmp_path}/curated")
    assert counted.collect() == P.category_counts(again).collect()
    found = jobs.build_labels(spark, f"{tmp_path}/curated", f"{tmp_path}/labeled")
    labeled = spark.read.parquet(f"{tmp_path}/labeled")
    assert found.first().asDict() == L.heuristic_counts(labeled).first().asDict()
    sides = jobs.build_split(spark, f"{tmp_path}/labeled", f"{tmp_path}/train", f"{tmp_path}/test")
    expected = {r["split"]: r.asDict() for r in S.split_balance(labeled).collect()}
    assert {r["split"]: r.asDict() for r in sides.collect()} == expected and len(expected) == 2
    for frame in (counted, found, sides):
        assert "parquet" not in frame._jdf.queryExecution().executedPlan().toString().lower()
    none = jobs.build_curated(spark, f"{base}/raw/reviews_*.parquet", f"{tmp_path}/none", ["no such category"])
    assert none.collect() == []
