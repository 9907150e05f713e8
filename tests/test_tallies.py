"""Histories from kept day sums equal histories made anew from all reviews."""

import random

import pytest
from helpers import as_dict, day, reviews

from review_signals.operators import history as H
from review_signals.operators import tallies as B
from review_signals.plans.jobs import update_lookups
from review_signals.sources.tables import read_table

REVIEWER = ("rh_total_reviews", "rh_avg_rating", "rh_rating_stddev", "rh_pct_verified", "rh_days_active", "rh_max_per_day")
PRODUCT = ("ph_total_reviews", "ph_avg_rating", "ph_pct_5star", "ph_pct_verified", "ph_days_active")
KEYS = {"customer_id": (H.reviewer_history, REVIEWER), "product_id": (H.product_history, PRODUCT)}


def batches(spark, seed=1):
    """Three batches that share keys and days; one reviewer holds a third of all rows, some have no id."""
    generator = random.Random(seed)
    rows = [
        {"customer_id": generator.choice(["hot", None, *(f"c{k}" for k in range(12))] + ["hot"] * 7), "product_id": f"p{generator.randrange(6)}",
         "star_rating": generator.choice([None, 1, 2, 3, 4, 5]), "verified_purchase": generator.choice([True, False, None]),
         "review_date": day(generator.randrange(9))}
        for _ in range(240)
    ]
    return [reviews(spark, [{**row, "review_id": f"{part}-{i}"} for i, row in enumerate(rows[part::3])]) for part in range(3)]


@pytest.mark.parametrize("key", sorted(KEYS))
def test_batch_by_batch_equals_all_at_once(spark, tmp_path, key):
    full, columns = KEYS[key]
    store, lookup, seen = str(tmp_path / "store"), None, None
    for number, batch in enumerate(batches(spark)):
        seen = batch if seen is None else seen.unionByName(batch)
        B.add_batch(batch, store, key, number)
        path = str(tmp_path / f"lookup{number}")
        B.refreshed(lookup, B.read_batches(spark, store), key, number).write.parquet(path)
        lookup = spark.read.parquet(path)
        assert as_dict(lookup, key, *columns) == as_dict(full(seen), key, *columns)
    assert as_dict(B.history(B.read_batches(spark, store), key), key, *columns) == as_dict(full(seen), key, *columns)


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    first, second, _ = batches(spark)
    store = str(tmp_path / "store")
    for number, batch in ((0, first), (1, first), (1, second)):
        B.add_batch(batch, store, "customer_id", number)
    expected = H.reviewer_history(first.unionByName(second))
    assert as_dict(B.history(B.read_batches(spark, store), "customer_id"), "customer_id", *REVIEWER) == as_dict(expected, "customer_id", *REVIEWER)


def test_compacted_sums_are_as_good_and_fewer(spark, tmp_path):
    store, compacted = str(tmp_path / "store"), str(tmp_path / "compacted")
    for number, batch in enumerate(batches(spark)):
        B.add_batch(batch, store, "customer_id", number)
    kept = B.read_batches(spark, store)
    B.compact(kept, compacted, "customer_id")
    fewer = B.read_batches(spark, compacted)
    assert fewer.count() == kept.select("customer_id", "review_date").distinct().count() < kept.count()
    assert {r.batch for r in fewer.collect()} == {2}
    assert as_dict(B.history(fewer, "customer_id"), "customer_id", *REVIEWER) == as_dict(B.history(kept, "customer_id"), "customer_id", *REVIEWER)


def test_only_keys_of_the_batch_are_worked_out_again(spark, tmp_path):
    """The other rows of the lookup are carried over as they are, whatever the store says about them."""
    store = str(tmp_path / "store")
    B.add_batch(reviews(spark, [{"customer_id": "a"}, {"customer_id": "b"}]), store, "customer_id", 0)
    marked = B.history(B.read_batches(spark, store), "customer_id").selectExpr("* except (rh_total_reviews)", "77L as rh_total_reviews")
    B.add_batch(reviews(spark, [{"customer_id": "b"}]), store, "customer_id", 1)
    assert as_dict(B.refreshed(marked, B.read_batches(spark, store), "customer_id", 1), "customer_id", "rh_total_reviews") == {"a": 77, "b": 2}


def test_sums_hold_no_reviews(spark, tmp_path):
    """A store has a row per key and day, however many reviews there are."""
    store = str(tmp_path / "store")
    B.add_batch(reviews(spark, [{"customer_id": "hot"}] * 500), store, "customer_id", 0)
    rows = B.read_batches(spark, store).collect()
    assert [(r.customer_id, r._n, r.batch) for r in rows] == [("hot", 500, 0)]
    with pytest.raises(FileNotFoundError, match="No batch"):
        B.read_batches(spark, str(tmp_path / "none"))


def test_empty_batch(spark, tmp_path):
    store = str(tmp_path / "store")
    B.add_batch(reviews(spark, [{"customer_id": "a"}]), store, "customer_id", 0)
    before = B.history(B.read_batches(spark, store), "customer_id")
    B.add_batch(reviews(spark, [{}]).limit(0), store, "customer_id", 1)
    assert as_dict(B.refreshed(before, read_table(spark, store), "customer_id", 1), "customer_id", "rh_total_reviews") == {"a": 1}


def test_job_takes_batches_in(spark, tmp_path):
    base, seen, written = str(tmp_path / "base"), None, {}
    for number, batch in enumerate(batches(spark, seed=2)):
        path = str(tmp_path / f"new{number}")
        batch.write.parquet(path)
        seen = batch if seen is None else seen.unionByName(batch)
        for _ in range(1 + number % 2):  # the second one is taken in twice
            written = update_lookups(spark, path, base, number)
    for name, key in (("reviewers", "customer_id"), ("products", "product_id")):
        full, columns = KEYS[key]
        assert as_dict(spark.read.parquet(written[name]), key, *columns) == as_dict(full(seen), key, *columns)
