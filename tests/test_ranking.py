"""Areas per group against plain sums and against the areas of one group alone."""

import random

import pytest

from review_signals.operators import model as M
from review_signals.operators import ranking as A

SCHEMA = "grp string, label double, fraud_probability double"


def plain(rows):
    """Both areas by going over the distinct scores of a group, from the highest on."""
    out = {}
    for group in {g for g, _, s in rows}:
        own = [(label, s) for g, label, s in rows if g == group and s is not None]
        if not own:
            continue
        tp = fp = roc = pr = 0
        precision = None
        for score in sorted({s for _, s in own}, reverse=True):
            hits = sum(label == 1.0 for label, s in own if s == score)
            misses = sum(label != 1.0 for label, s in own if s == score)
            now = (tp + hits) / (tp + hits + fp + misses)
            roc += misses * (2 * tp + hits) / 2
            pr += hits * ((now if precision is None else precision) + now) / 2
            tp, fp, precision = tp + hits, fp + misses, now
        out[group] = (tp + fp, tp, roc / (tp * fp) if tp * fp else None, pr / tp if tp else None)
    return out


def found(frame):
    return {r.grp: (r.reviews, r.positives, r.roc_auc, r.pr_auc) for r in frame.collect()}


def close(ours, theirs):
    assert set(ours) == set(theirs)
    for group, expected in theirs.items():
        assert ours[group] == pytest.approx(expected) if None not in expected else ours[group][:2] == expected[:2]
        assert [v is None for v in ours[group]] == [v is None for v in expected]


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_equals_plain_sums(spark, slices):
    generator = random.Random(slices)
    rows = [(generator.choice(["a", "b", None]), float(generator.random() < 0.3), generator.choice([None, round(generator.random(), 2)])) for _ in range(600)]
    rows += [("no positives", 0.0, 0.4), ("no negatives", 1.0, 0.4), ("no negatives", 1.0, 0.7), ("no scores", 1.0, None)]
    rows += [("ties", float(k % 2), 0.5) for k in range(10)]
    close(found(A.areas_by(spark.createDataFrame(rows, SCHEMA).repartition(4), "grp", slices=slices)), plain(rows))


def test_one_group_holds_nearly_all_rows(spark):
    """The points of the large group are spread over the slices, and its areas are those the library gives for it alone."""
    generator = random.Random(5)
    rows = [("large" if k % 50 else f"g{k % 3}", float(generator.random() < 0.2), generator.random()) for k in range(20_000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    points = A.sliced(A.curve_points(frame, "grp"), 8, "grp")
    sizes = [r["count"] for r in points.groupBy("slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 0.25 * len(rows)
    alone = M.areas(frame.where("grp = 'large'").selectExpr("label", "fraud_probability"))
    large = found(A.areas_by(frame, "grp", slices=8))["large"]
    assert large[2:] == pytest.approx((alone["roc_auc"], alone["pr_auc"]))


def test_no_group_is_sorted_in_one_task(spark):
    """Running totals are formed by slice; only the totals of slices are put together by group alone."""
    frame = spark.createDataFrame([("a", 1.0, 0.5)], SCHEMA)
    plan = A.areas_by(frame, "grp")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert windows and "SinglePartition" not in plan
    # a window that sorts by score always has the slice among its keys
    assert all("slice" in line.split("windowspecdefinition(")[1].split("score")[0] for line in windows if "score" in line)


def test_empty_table(spark):
    assert A.areas_by(spark.createDataFrame([], SCHEMA), "grp").collect() == []


def test_without_keys_all_rows_are_one_group(spark):
    rows = [("a", float(k % 3 == 0), (k * 7 % 11) / 11) for k in range(50)]
    (row,) = A.areas_by(spark.createDataFrame(rows, SCHEMA), slices=4).collect()
    expected = plain(rows)["a"]
    assert (row.reviews, row.positives, row.roc_auc, row.pr_auc) == pytest.approx(expected)
