"""Markdown report of one training run, from the small result frames of the evaluation."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame

METRIC_TITLES = {
    "accuracy": "Accuracy",
    "weighted_precision": "Weighted precision",
    "weighted_recall": "Weighted recall",
    "f1": "Weighted F1",
    "roc_auc": "ROC AUC",
    "pr_auc": "Area under PR",
}


def _table(title: str, header: tuple[str, ...], rows: list[tuple]) -> str:
    lines = [f"## {title}", "", "| " + " | ".join(header) + " |", "|" + "---|" * len(header)]
    lines += ["| " + " | ".join(str(v) for v in row) + " |" for row in rows]
    return "\n".join(lines)


def training_report(title: str, rows: int, columns: list[str], excluded: Collection[str], metrics: DataFrame,
                    confusion: DataFrame, importances: DataFrame) -> str:
    """All inputs are bounded: one metrics row, one row per outcome, one row per feature."""
    measured = metrics.first()
    summary = [("Rows", f"{rows:,}"), ("Features", len(columns)), ("Excluded", ", ".join(sorted(excluded)) or "none")]
    parts = [
        f"# {title}",
        _table("Data", ("Item", "Value"), summary),
        _table("Metrics", ("Metric", "Value"), [(t, f"{measured[c]:.4f}") for c, t in METRIC_TITLES.items()]),
        _table("Confusion matrix", ("Label", "Prediction", "Reviews", "Share"),
               [(r["label"], r["prediction"], r["reviews"], f"{r['row_share']:.4f}") for r in confusion.collect()]),
        _table("Feature importance", ("Feature", "Importance"),
               [(r["feature"], f"{r['importance']:.6f}") for r in importances.collect()]),
        "The labels come from heuristics. The figures say how well the model relearns these rules on held-out\n"
        "reviews, not how many reviews are fake.",
    ]
    return "\n\n".join(parts) + "\n"
