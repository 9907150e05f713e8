import datetime as dt

import pytest
from pyspark.sql import functions as F

from review_signals.operators.curate import curate, text_columns
from review_signals.functions.scalars import date_from_epoch_days
from review_signals.sources.tables import MissingInput, read_table, write_bucketed, write_by_category, write_partitioned

RAW = """marketplace binary, customer_id bigint, review_id binary, product_id binary, product_title binary,
    product_category binary, star_rating string, helpful_votes string, total_votes bigint,
    verified_purchase boolean, review_headline binary, review_body binary, review_date int"""


def raw(spark, rows):
    def row(rid, category=b"Books", customer=1, product=b"p", stars="4", helpful="0", body=b"text", when=16500):
        return (b"US", customer, rid, product, b"title", category, stars, helpful, 0, True, None, body, when)

    return spark.createDataFrame([row(**r) for r in rows], RAW)


def test_invalid_rows_go_and_types_are_right(spark):
    frame = raw(spark, [
        dict(rid=b"ok"), dict(rid=b"zero", stars="0"), dict(rid=b"six", stars="6"), dict(rid=b"none", stars=None),
        dict(rid=b"text", stars="x"), dict(rid=b"nocustomer", customer=None), dict(rid=b"noproduct", product=None),
        dict(rid=b"toys", category=b"Toys"), dict(rid=b"nobody", body=None, helpful="many", when=0),
    ])
    out = curate(frame)
    kept = {r["review_id"]: r for r in out.collect()}
    assert set(kept) == {"ok", "nobody"}
    assert kept["ok"]["customer_id"] == "1" and kept["ok"]["star_rating"] == 4
    assert kept["ok"]["review_date"] == dt.date(2015, 3, 6) and kept["ok"]["review_headline"] == ""
    assert kept["nobody"]["review_body"] == "" and kept["nobody"]["helpful_votes"] is None
    assert kept["nobody"]["review_date"] == dt.date(1970, 1, 1)
    assert [f.name for f in out.schema.fields] == [f.name for f in frame.schema.fields]


def test_category_filter_reaches_the_scan_of_byte_columns(spark, tmp_path):
    raw(spark, [dict(rid=b"a"), dict(rid=b"b", category=b"Toys")]).write.parquet(str(tmp_path / "raw"))
    out = curate(read_table(spark, str(tmp_path / "raw")), ["Books", "Apparel"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "In(product_category" in plan
    assert [r["review_id"] for r in out.collect()] == ["a"]


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Asia/Tokyo"])
def test_epoch_days_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = spark.range(1).select(date_from_epoch_days(F.lit(16500)).cast("string").alias("d")).first()["d"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == "2015-03-06"


def test_partitioned_write_and_pruned_read(spark, tmp_path):
    rows = text_columns(raw(spark, [dict(rid=b"a"), dict(rid=b"b", category=b"Toys")]))
    for rebalance in (False, True):
        path = str(tmp_path / f"t{rebalance}")
        write_partitioned(rows, path, "product_category", rebalance=rebalance)
        back = read_table(spark, path).where("product_category = 'Toys'")
        plan = back._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(product_category" in plan
        assert [r["review_id"] for r in back.collect()] == ["b"]
    write_by_category(rows.limit(1), path)
    assert read_table(spark, path).count() == 1


def test_missing_input_is_named(spark, tmp_path):
    with pytest.raises(MissingInput, match="Run the download first"):
        read_table(spark, str(tmp_path / "raw_*.parquet"), hint="Run the download first")


def test_several_files_scan_as_one(spark, tmp_path):
    for name in "ab":
        spark.createDataFrame([(name,)], "x string").write.parquet(str(tmp_path / f"part_{name}.parquet"))
    assert read_table(spark, str(tmp_path / "part_*.parquet")).count() == 2


def test_bucketed_lookup_does_not_move_in_a_join(spark, tmp_path):
    lookup = spark.range(1000).selectExpr("cast(id as string) as customer_id", "id as v")
    write_bucketed(lookup, "lookup_bucketed", str(tmp_path / "lookup"), "customer_id", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(100).selectExpr("cast(id as string) as customer_id")
        joined = rows.join(spark.table("lookup_bucketed"), "customer_id", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert joined.where("v is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table lookup_bucketed")
