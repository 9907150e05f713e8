from __future__ import annotations

import math
import random

import pytest

from review_signals.llm.oracle import _risk_thresholds
from review_signals.llm.risk_thresholds import (
    COUNTS,
    RULES,
    Risk,
    binomial_tail,
    judge,
    keep,
    labels_needed,
    last_valid,
    measure,
    select_settings,
    steps,
)

LABELS = "doc_id long, quality int, toxic int"


def test_binomial_tail_is_exact():
    for n, p in ((1, 0.3), (20, 0.05), (300, 0.01), (5000, 0.02)):
        for k in range(int(n * p) + 1):
            exact = math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert binomial_tail(k, n, p) == pytest.approx(exact, rel=1e-9)
    assert binomial_tail(50, 100, 0.1) == 1.0 and binomial_tail(0, 0, 0.1) == 1.0


def good_text(generator):
    return " ".join("".join(generator.choices("abcdefgh", k=generator.randrange(3, 8))) for _ in range(40)) + "."


def test_settings_need_enough_labels_and_hold_the_risk(docs):
    generator = random.Random(1)
    rows = [(i, good_text(generator)) for i in range(900)]
    rows = [(i, t.replace(" ", "# ") if i % 200 == 0 else t) for i, t in rows]
    measured = measure(docs(rows).selectExpr("*", "if(doc_id < 40, 'few', 'many') as stratum"), ("doc_id", "stratum"))
    chosen = {r.stratum: r for r in select_settings(measured, "stratum", RULES, Risk(risk=0.05)).collect()}
    assert chosen["few"].last_step == -1 and all(chosen["few"][rule.name] is None for rule in RULES)
    assert chosen["many"]["symbols"] == 0.01 and chosen["many"]["upper_case"] == 0.1
    strict = {r.stratum: r for r in select_settings(measured, "stratum", RULES, Risk(risk=0.01)).collect()}
    assert strict["many"]["symbols"] == 0.2  # five good documents of 860 would be lost from 0.1 on


def test_junk_goes_and_clean_documents_stay(spark, docs):
    generator = random.Random(2)
    rows = [(i, good_text(generator)) for i in range(1200)] + [(5000 + i, good_text(generator).replace(" ", "### ")) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1200)] + [(5001, 0, 0), (5001, 1, 0), (None, 1, 0)], LABELS)
    judged = {r.doc_id: r for r in judge(docs(rows), labels).collect()}
    assert sum(not judged[i].kept for i in range(1200)) <= 12
    assert all(not judged[5000 + i].kept and judged[5000 + i].broken_rule for i in range(40))


COUNTED = "lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_lines long, n_closed long"


def measured_rows(spark, **strata):
    """So many good documents per stratum, words of so many letters, so many documents full of symbols, as many others of
    long words."""
    rows = []
    for name, (n, letters, odd) in strata.items():
        for i in range(n):
            long = 40 if odd <= i < 2 * odd else letters
            rows.append((name, 100, 100 * long, 60 * letters if i < odd else 0, 0, 0, 2, 10, 10))
    return spark.createDataFrame(rows, COUNTED)


def chosen_of(frame):
    return {r.stratum: r for r in frame.collect()}


def test_what_all_rules_lose_together_counts(spark):
    good = measured_rows(spark, en=(2000, 5, 0), de=(493, 5, 0), fr=(498, 5, 2), es=(312, 5, 0), it=(2000, 5, 6))
    chosen = chosen_of(select_settings(good, "lang"))
    assert labels_needed(0.05 / 5, 0.01) == 459
    assert all(chosen[lang].last_step == len(steps(RULES)) - 1 for lang in ("en", "de"))
    assert chosen["es"].last_step == -1  # too few for any test
    assert chosen["fr"].last_step == -1  # the first step loses two of 498, the fewest that fail are one
    # six of 2,000 pass under the first cutoff for symbols, but six more are lost under the first for long words
    assert binomial_tail(6, 2000, 0.01) < 0.01 and chosen["it"]["symbols"] == 0.5
    assert binomial_tail(12, 2000, 0.01) > 0.01 and chosen["it"]["long_words"] is None and chosen["it"].last_step == 4


def test_the_joint_loss_is_bounded():
    """Rules that lose a bit more than the risk together, in all ways of sharing it, hardly ever pass."""
    generator = random.Random(4)
    for shares in ([0.011], [0.0016] * 7, [0.009, 0.002]):
        wrong = 0
        for _ in range(400):
            lost = {}
            for step, share in enumerate(shares):
                lost[step] = sum(generator.random() < share for _ in range(700))
            wrong += last_valid(lost, 700, 44, 0.01, 0.05) >= len(shares) - 1
        assert wrong <= 0.07 * 400


def test_equals_the_sql_with_valid_settings(spark):
    """Tables where some strata have enough labels and others don't."""
    from tests.oracle_check import connect, differences

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    risk = Risk(risk=0.02)
    result = judge(docs, labels, risk=risk)
    assert {r.broken_rule for r in result.select("broken_rule").distinct().collect()} - {None}
    assert differences(result, connect("/root/testdata/sf0.01"), _risk_thresholds(risk)) == []


def test_keep_keeps_what_judge_keeps(spark, docs):
    generator = random.Random(3)
    rows = [(i, good_text(generator)) for i in range(700)] + [(5000 + i, good_text(generator).replace(" ", "### ")) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(700)], LABELS)
    frame = docs([*rows, (9000, None), (9001, "few words")]).selectExpr("*", "7 as n_words", "8 as stratum")
    assert judge(frame, labels).columns[:8] == ["doc_id", *COUNTS[:5], "base_failed", "kept"]
    kept = keep(frame, labels)
    assert kept.columns == frame.columns and {r.n_words for r in kept.collect()} == {7}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in judge(frame, labels).filter("kept").collect()} == set(range(700))


def test_odd_texts(spark, docs):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(1, None), (2, ""), (3, "a b c d e f g h i j"), (4, "x y z x y z x y z x y z"), (5, "é# é\né# é\n\n \nq"), (6, long), (6, long)]
    frame = docs(rows).selectExpr("*", "1 as n_words", "2 as stratum", "3 as kept")
    result = judge(frame.drop("lang").selectExpr("*", "cast(null as string) as lang"), spark.createDataFrame([], LABELS)).collect()
    counts = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in result}
    assert len(result) == 7
    assert counts[1] == counts[2] == (0, 0, 0, 0, 0, True, False)
    assert counts[3] == (10, 10, 0, 0, 0, False, True)
    assert counts[4] == (12, 12, 0, 0, 12, True, False)
    assert counts[5] == (5, 7, 2, 1, 0, True, False)
    assert counts[6][:1] == (50_000,) and counts[6][-1]
    assert judge(docs([]), spark.createDataFrame([], LABELS)).collect() == []
