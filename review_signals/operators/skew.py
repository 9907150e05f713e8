"""Joining per-key figures to rows when single keys may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_signals.config import SkewRule


def key_sizes(rows: DataFrame, on: list[str]) -> DataFrame:
    """Rows per key, pre-aggregated before the shuffle."""
    return rows.groupBy(*on).agg(F.count("*").alias("_size"))


def attach(
    rows: DataFrame,
    stats: DataFrame,
    on: list[str],
    salt_by: list[str],
    size: str | None = None,
    sizes: DataFrame | None = None,
    how: str = "left",
    rule: SkewRule = SkewRule(),
) -> DataFrame:
    """Join ``stats`` (one row per key) to ``rows`` without sending a hot key to a single task.

    The rows per key come either from the column ``size`` of ``stats`` or from ``sizes``, a frame as made
    by :func:`key_sizes` (needed when ``stats`` was computed from other rows). Hot keys by ``rule``, of which
    there can't be more than ``rule.max_hot_keys``, are answered from a broadcast of that bounded size. Their
    rows get a salted key in the shuffle join, which spreads them evenly and lets them pass unmatched. All
    other rows take the ordinary join, whose strategy Spark picks by size and whose large partitions it splits.
    """
    values = [c for c in stats.columns if c not in on]
    # Null keys match nothing. Dropping them here gives both uses below the same plan, whose shuffle Spark
    # then runs once.
    has_key = " and ".join(f"{c} is not null" for c in on)
    stats = stats.where(has_key)
    known = stats.withColumn("_found", F.lit(True))
    carried = [*values, "_found"]

    measured, weight = (stats, size) if sizes is None else (sizes.where(has_key), "_size")
    large = measured.where(F.col(weight) >= rule.hot_rows)
    # A share of the sum is reached by a bounded number of keys; the sum is one row, read as a scalar. The added zero
    # is made of all figures: the plan then reads the same columns as the others and shares their shuffle.
    used = ", ".join(values if sizes is None else [weight])
    whole = F.sum(F.expr(f"{weight} + pmod(xxhash64({used}), 1)"))
    least = large.agg((whole / rule.max_hot_keys).alias("least")).scalar()
    top = large.where(F.col(weight) >= least)
    if sizes is None:
        top = top.withColumn("_found", F.lit(True))
    else:
        # The few hot keys go to the figures, not the figures to them. A hot key may be without figures: it
        # is still hot.
        top = top.select(*on)
        top = top.join(F.broadcast(known.join(F.broadcast(top), on, "left_semi")), on, "left")
    hot = top.select(*on, F.struct(*carried).alias("_hot"))

    spread = f"pmod(xxhash64({', '.join(salt_by)}), {rule.salts}) + 1"
    marked = rows.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.expr(f"if(_hot is null and {has_key}, 0, {spread})")
    )
    # On the side of the figures the salt is always 0. It is not written as a literal: the optimizer would
    # turn that into a filter on the rows and drop the salt from the shuffle key. Never null, so that no
    # filter on it is added below, which would tell the two uses of the figures apart.
    zero = f"coalesce(pmod(xxhash64({on[0]}), 1), 0) as _salt"
    cold = known.selectExpr(*on, zero, f"struct({', '.join(carried)}) as _cold")

    joined = marked.join(cold, [*on, "_salt"], "left")
    if how == "inner":
        joined = joined.where("if(_hot is not null, _hot._found, _cold._found)")
    picked = [f"if(_hot is not null, _hot.{c}, _cold.{c}) as {c}" for c in values]
    return joined.selectExpr(*rows.columns, *picked)
