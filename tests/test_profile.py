import datetime as dt

from helpers import as_dict, day, reviews

from review_signals.operators import profile as P


def test_histogram_edges_are_exact(spark):
    votes = [(0, 5), (1, 20), (3, 20), (7, 20), (19, 20), (20, 20), (25, 20), (0, 0), (None, 3)]
    frame = reviews(spark, [dict(helpful_votes=h, total_votes=t) for h, t in votes])
    got = as_dict(P.helpful_ratio_histogram(frame), "bin", "reviews")
    assert got == {0: 1, 1: 1, 3: 1, 7: 1, 19: 3}


def test_reviewer_activity_and_heavy_reviewers(spark):
    rows = [dict(customer_id="a")] * 11 + [dict(customer_id="b")] * 11 + [dict(customer_id="c")] * 50
    frame = reviews(spark, rows)
    assert as_dict(P.reviewer_activity(frame), "n_reviews", "reviewers") == {11: 2, 50: 1}
    assert P.reviewer_activity(frame, limit=1).first()["n_reviews"] == 11
    got = as_dict(P.heavy_reviewers(frame), "more_than", "reviewers", "reviews", "review_share")
    assert got == {10: (3, 72, 1.0), 49: (1, 50, 50 / 72)}


def test_ties_are_ordered_by_key(spark):
    frame = reviews(spark, [dict(customer_id=c) for c in "dcba"] + [dict(customer_id="z")] * 2)
    got = [(r["rank"], r["customer_id"]) for r in P.top_reviewers(frame, 3).collect()]
    assert got == [(1, "z"), (2, "a"), (3, "b")]
    assert [r["customer_id"] for r in P.top_reviewers_in_period(frame, 3).collect()] == ["z", "a", "b"]


def test_rates_per_day(spark):
    frame = reviews(spark, [dict(review_date=day(d)) for d in (0, 0, 3)] + [dict(customer_id="b", review_date=day(5))])
    assert P.top_reviewers(frame).first()["per_day"] == 3 / 4
    assert P.top_reviewers_in_period(frame).first()["per_day_of_period"] == 3 / 6


def test_pivots(spark):
    frame = reviews(spark, [dict(star_rating=5), dict(star_rating=5, product_category="Apparel"),
                            dict(star_rating=1, verified_purchase=False)])
    wide = P.rating_by_category(frame, ["Books", "Apparel"])
    assert wide.columns == ["star_rating", "books", "apparel"]
    assert [tuple(r) for r in wide.collect()] == [(1, 1, 0), (5, 1, 1)]
    assert as_dict(P.verified_by_category(frame), "product_category", "unverified", "verified") == {
        "Apparel": (0, 1), "Books": (1, 1)}


def test_spikes_need_a_full_baseline_of_calendar_days(spark):
    two = reviews(spark, [dict(review_date=day(d)) for d in (0, 100, 100)])
    assert P.velocity_spikes(two).collect() == []
    gap = reviews(spark, [dict(review_date=day(d)) for d in (0, 1, 9, 9)] + [dict(review_date=day(3))] * 5)
    got = [(r["review_date"], round(r["baseline"], 6), round(r["ratio"], 6)) for r in P.velocity_spikes(gap).collect()]
    assert got == [(day(9), round(5 / 7, 6), 2.8)]


def test_spikes_compare_with_the_days_before(spark):
    frame = reviews(spark, [dict(review_date=day(d)) for d in [*range(7), 7, 7, 8]])
    got = P.velocity_spikes(frame).collect()
    assert [(r["review_date"], r["baseline"], r["ratio"]) for r in got] == [(day(7), 1.0, 2.0)]


def test_weekdays_start_on_monday(spark):
    frame = reviews(spark, [dict(review_date=dt.date(2024, 1, 1)), dict(review_date=dt.date(2024, 1, 7)),
                            dict(review_date=None)])
    assert as_dict(P.weekday_velocity(frame), "weekday", "days", "reviews", "mean_per_day") == {
        0: (1, 1, 1.0), 6: (1, 1, 1.0)}


def test_entity_counts_exact_and_sketched(spark):
    frame = reviews(spark, [dict(customer_id=str(i % 400), product_id=str(i % 30)) for i in range(900)])
    assert tuple(P.entity_counts(frame).first()) == (900, 400, 30)
    _, people, goods = P.entity_counts(frame, exact=False).first()
    assert abs(people - 400) <= 12 and abs(goods - 30) <= 1


def test_column_profile_and_sample(spark):
    frame = reviews(spark, [dict(review_body="x" * 100), dict(review_body=None)])
    got = as_dict(P.column_profile(frame), "column_name", "data_type", "row_count", "null_count")
    assert got["review_body"] == ("string", 2, 1) and got["star_rating"] == ("int", 2, 0)
    assert len(P.sample_rows(frame, "review_id", [], "review_body", 1).first()["headline"]) == 60


def test_top_k_needs_no_full_sort(spark):
    frame = reviews(spark, [dict()])
    assert "TakeOrderedAndProject" in P.top_reviewers(frame)._jdf.queryExecution().executedPlan().toString()


def test_counts_aggregate_before_the_shuffle(spark):
    plan = P.category_counts(reviews(spark, [dict()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")
