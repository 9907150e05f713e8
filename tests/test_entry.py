"""The driver contract, and what stands on its own."""

import re
from pathlib import Path

import __spark_entry__ as contract
from review_signals.plans.queries import REGISTRY

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_outside_uses_the_training_data_operators():
    for path in (ROOT / "review_signals").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"review_signals\.llm|corpus_pipeline", path.read_text(encoding="utf-8")), path


def test_all_library_queries_are_listed_and_have_sql():
    assert set(REGISTRY) <= set(contract.queries())
    assert set(REGISTRY) == set(REGISTRY) & set(contract.oracle_sql())


def test_feature_plan_reads_the_staged_rows_only(spark):
    """The labelled rows are written once; features and both histories read them instead of the source tables."""
    frame = REGISTRY["review_features"](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    # the rows, and each history in three uses, which share their shuffles when the plan runs
    assert "lineitem" not in plan and plan.count("FileScan") <= 7
