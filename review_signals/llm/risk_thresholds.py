"""Quality rules whose cutoffs come with a guarantee on how many good documents they reject.

Every rule compares one signal of a text with a cutoff. A setting has a cutoff for some of the rules, and the settings
form one fixed sequence: each step tightens one rule by one cutoff, the loosest cutoffs of all rules come first, then
the next ones. On labelled documents, the number of good ones that a whole setting would reject, by whichever rule, is
binomial; a setting is valid for a stratum if the exact binomial test rejects "it loses more than ``risk`` of the good
documents" (the upper Clopper-Pearson bound is then at most ``risk``). A stratum's settings are tested in their order up
to the first failure, so that they need no correction among themselves; the error is split over the strata. With
probability 1 - ``error`` no stratum loses more than ``risk`` of its good documents, by all rules together. A stratum
with too few labelled good documents (``labels_needed``) has no valid setting, and its rules reject nothing.

Defined cases: a null text has no words. A null stratum is a stratum of its own. A null doc_id has no label. Repeated
rows are measured once each; of several labels of a document the worst counts once. Empty tables give empty results;
without labels only the base rule works. Columns other than id, text and stratum are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_signals.llm.shared import bounded, dropped, staged
from review_signals.llm.text_arrays import Texts, chunks, covered, mix, repeated, roll, tidy

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines", "n_closed")
_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_IS_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_IS_CLOSER = np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))


@dataclass(frozen=True)
class Rule:
    """Rejects a text whose ``top / bottom`` is over the cutoff (or under it, with ``below``), the loosest cutoff first."""

    name: str
    top: str
    bottom: str
    cutoffs: tuple[float, ...]
    below: bool = False


RULES = (
    Rule("symbols", "n_symbols", "word_chars", (0.5, 0.3, 0.2, 0.1, 0.05, 0.02, 0.01)),
    Rule("upper_case", "n_upper", "word_chars", (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("repeated_words", "n_repeat_words", "n_words", (0.8, 0.5, 0.3, 0.2, 0.1, 0.05)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", (0.8, 0.5, 0.3, 0.2, 0.1)),
    Rule("closed_words", "n_closed", "n_words", (0.9, 0.7, 0.5, 0.4, 0.3)),
    Rule("long_words", "word_chars", "n_words", (30, 20, 15, 12, 10)),
    Rule("short_words", "word_chars", "n_words", (1.5, 2, 2.5, 3, 3.5), below=True),
)


@dataclass(frozen=True)
class Risk:
    risk: float = 0.01
    error: float = 0.05
    max_broadcast_strata: int = 100_000


def count_signals(texts: Texts) -> dict[str, np.ndarray]:
    """The counts of each text of a chunk, by name."""
    starts, ends = texts.words
    owner = texts.owner(starts)
    size = len(texts)
    words = texts.hashes(starts, ends)
    salt = mix(owner.astype(np.uint64) + np.uint64(1))
    windows = np.flatnonzero(owner[: max(0, len(owner) - 4)] == owner[4:])
    again = windows[repeated(mix(roll(words, 5)[windows] ^ salt[windows]))]
    line_starts, line_ends = texts.lines
    line_owner = texts.owner(line_starts)
    lines = mix(texts.hashes(line_starts, line_ends) ^ mix(line_owner.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(lines, return_index=True)
    n_lines = np.bincount(line_owner, minlength=size)
    return {
        "n_words": np.bincount(owner, minlength=size),
        "word_chars": texts.count(texts.inside & ((texts.data & 0xC0) != 0x80)),
        "n_symbols": texts.count(_IS_SYMBOL[texts.data]),
        "n_dup_lines": n_lines - np.bincount(line_owner[first], minlength=size),
        "n_repeat_words": np.bincount(owner[covered(again, 5, len(owner))], minlength=size),
        "n_upper": texts.count(_IS_UPPER[texts.data]),
        "n_lines": n_lines,
        "n_closed": np.bincount(owner[_IS_CLOSER[texts.data[ends - 1]]], minlength=size),
    }


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), prefix: str = "") -> DataFrame:
    """The counts of every whole text, beside the columns ``keep``; the names of the counts begin with ``prefix``."""
    schema = docs.select(*keep).schema
    for name in COUNTS:
        schema = schema.add(prefix + name, "long")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            counts = count_signals(texts)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(name) for name in keep), *(pa.array(counts[name], pa.int64()) for name in COUNTS)],
                names=schema.names,
            )

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(tidy(task), schema)


def _log_gamma(values: np.ndarray) -> np.ndarray:
    """log of the gamma function for values of 1 or more, by Stirling's series after a shift by 8."""
    shifted = values + 8.0
    series = (shifted - 0.5) * np.log(shifted) - shifted + 0.5 * math.log(2 * math.pi) + 1 / (12 * shifted) - 1 / (
        360 * shifted**3) + 1 / (1260 * shifted**5)
    return series - sum(np.log(values + step) for step in range(8))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of Bin(n, p), exact but for terms far below double precision; 1.0 where k is over the mean."""
    if n <= 0 or k > n * p:
        return 1.0
    lowest = max(0, k - 60 * math.isqrt(int(n * p) + 1) - 100)
    i = np.arange(lowest, k + 1, dtype=float)
    logs = (_log_gamma(np.array([n + 1.0])) - _log_gamma(i + 1) - _log_gamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p))
    return float(min(1.0, np.exp(logs).sum()))


def steps(rules: tuple[Rule, ...]) -> list[tuple[Rule, float]]:
    """The rule that each step tightens, and its cutoff from then on."""
    longest = max(len(rule.cutoffs) for rule in rules)
    return [(rule, float(rule.cutoffs[place])) for place in range(longest) for rule in rules if place < len(rule.cutoffs)]


def first_step(rules: tuple[Rule, ...], prefix: str = "") -> Column:
    """The first step whose setting rejects a measured text, null if none does: it and all later ones do."""

    def breaks(rule: Rule, cutoff: float) -> Column:
        top, bottom = F.col(prefix + rule.top), F.col(prefix + rule.bottom)
        signal = F.when(bottom > 0, top / bottom)
        return signal < cutoff if rule.below else signal > cutoff

    found = [F.when(breaks(rule, cutoff), number) for number, (rule, cutoff) in enumerate(steps(rules))]
    return F.coalesce(*found)


def labels_needed(level: float, risk: float) -> int:
    """Good documents with which a setting that loses none of them passes a test at ``level``."""
    return math.ceil(math.log(level) / math.log1p(-risk))


def last_valid(lost: Mapping[int, int], n: int, size: int, risk: float, level: float) -> int:
    """The last valid one of ``size`` steps, or -1; ``lost`` has how many of ``n`` documents each step is the first to lose."""
    total = 0
    for step in range(size):
        total += lost.get(step, 0)
        if binomial_tail(total, n, risk) > level:
            return step - 1
    return size - 1


def select_settings(good: DataFrame, stratum: str, rules: tuple[Rule, ...] = RULES, risk: Risk = Risk()) -> DataFrame:  # noqa: B008
    """One row per stratum with its ``last_step``, -1 if no setting is valid, and the cutoff of each rule there, or null;
    ``good`` are the measured good documents.

    One aggregation counts the documents by the step that loses them first; the tests run on its rows, in tasks.
    """
    known = good.select(F.col(stratum).alias("stratum"), first_step(rules).alias("step"))
    counted = known.groupBy("stratum", "step").agg(F.count(F.lit(1)).alias("n")).groupBy("stratum").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("step", "n")).alias("lost"))
    counted = staged(counted, "risk-counts")
    level, order = risk.error / max(1, counted.count()), steps(rules)
    names = [rule.name for rule in rules]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n, lost in zip(batch.column("n").to_pylist(), batch.column("lost").to_pylist(), strict=True):
                by_step = {entry["step"]: entry["n"] for entry in lost if entry["step"] is not None}
                last = last_valid(by_step, n, len(order), risk.risk, level)
                rows.append((last, {rule.name: cutoff for rule, cutoff in order[:last + 1]}))
            yield pa.RecordBatch.from_arrays([
                batch.column("stratum"), pa.array([last for last, _ in rows], pa.int32()),
                *(pa.array([held.get(name) for _, held in rows], pa.float64()) for name in names),
            ], names=["stratum", "last_step", *names])

    kind = counted.schema["stratum"].dataType.simpleString()
    return counted.mapInArrow(choose, f"stratum {kind}, last_step int, " + ", ".join(f"{name} double" for name in names))


def base_failed(prefix: str = "") -> Column:
    n_words, again = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n_words < 10) | (100 * again > 20 * n_words)


def learn(measured: DataFrame, labels: DataFrame, stratum: str, rules: tuple[Rule, ...], risk: Risk) -> DataFrame:
    """The last valid step of each stratum, as ``__stratum`` and ``__last``."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("doc_id")
    counted = measured.filter(~base_failed()).join(good, "doc_id", "left_semi")
    settings = bounded(staged(select_settings(counted, stratum, rules, risk), "settings"), risk.max_broadcast_strata)
    return settings.select(F.col("stratum").alias("__stratum"), F.col("last_step").alias("__last"))


def judge(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES, risk: Risk = Risk()  # noqa: B008
) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and the broken rule, if any, of every document: the rule of the first step that
    rejects it."""
    measured = staged(measure(docs.select("doc_id", "text", F.col(stratum).alias("stratum")), ("doc_id", "stratum")), "measured")
    settings = learn(measured, labels, "stratum", rules, risk)
    judged = measured.join(settings, F.col("stratum").eqNullSafe(F.col("__stratum")), "left").withColumn("step", first_step(rules))
    names = F.array(*(F.lit(rule.name) for rule, _ in steps(rules)))
    broken = F.when(F.col("step") <= F.col("__last"), F.get(names, F.col("step")))
    return judged.select(
        "doc_id", *COUNTS[:5], base_failed().alias("base_failed"), (~base_failed() & broken.isNull()).alias("kept"),
        *COUNTS[5:], broken.alias("broken_rule"),
    )


def keep(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES, risk: Risk = Risk()  # noqa: B008
) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns. Texts are measured a second time instead of
    being joined to their verdicts, so nothing of them is shuffled."""
    measured = staged(measure(docs.select("doc_id", "text", F.col(stratum).alias("stratum")), ("doc_id", "stratum")), "measured")
    settings = learn(measured, labels, "stratum", rules, risk)
    dropped(measured)
    rows = measure(docs, tuple(docs.columns), "__").withColumn("__step", first_step(rules, "__"))
    rows = rows.join(settings, F.col(stratum).eqNullSafe(F.col("__stratum")), "left")
    rejected = base_failed("__") | F.coalesce(F.col("__step") <= F.col("__last"), F.lit(False))
    return rows.filter(~rejected).select(*docs.columns)
