from __future__ import annotations

import hashlib
import random

from review_signals.llm.line_windows import deduplicate
from review_signals.llm.queries import REGISTRY

from .conftest import SF_DIR


def brute_force(texts):
    """Per document the text that stays, its lines with a word and how many of them go."""
    first, worded, gone = {}, {}, {}
    for i in sorted(texts):
        lines = (texts[i] or "").split("\n")
        worded[i] = [k for k, line in enumerate(lines) if line.strip(" \t\n\v\f\r")]
        gone[i] = set()
        for k in range(len(worded[i]) - 2):
            window = tuple(lines[j] for j in worded[i][k:k + 3])
            if window in first:
                gone[i].update(worded[i][k:k + 3])
            first.setdefault(window, (i, k))
    return {
        i: (None if t is None else "\n".join(line for k, line in enumerate(t.split("\n")) if k not in gone[i]), len(worded[i]), len(gone[i]))
        for i, t in texts.items()
    }


def got(frame):
    return {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in frame.collect()}


def test_equals_brute_force(docs):
    generator = random.Random(2)
    texts = {i: "\n".join(generator.choices(["a", "b b", "c", "", " ", "d\r", "é"], k=generator.randrange(14))) for i in range(300)}
    texts |= {900: None, 901: "", 902: "\n\n\n", 903: "x\nx\nx\nx\nx", 904: "a\nb b\nc\n", 905: "z" * 200_000 + "\nq\nr\ns"}
    assert got(deduplicate(docs(texts.items()))) == brute_force(texts)


def test_keeps_a_place_for_each_line_and_all_columns(docs):
    texts = {i: "\n".join(f"line {(i * 7 + j) % 40}" for j in range(25)) for i in range(40)}
    frame = deduplicate(docs(texts.items()).selectExpr("*", "1 as window", "2 as line", "3 as n_spans"))
    assert {"lang", "source", "n_chars", "window", "line"} < set(frame.columns)
    rows = frame.collect()
    assert {line for r in rows for line in r.text.split("\n") if line} == {f"line {k}" for k in range(40)}


def test_hot_window_and_repeated_rows(spark):
    shared = "one\ntwo\nthree"
    rows = [(i, f"{shared}\nown {i}") for i in range(400)] + [(0, f"{shared}\nown 0"), (None, shared), (None, shared)]
    result = deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.n_removed for r in result) == [0, 0] + [3] * 401
    assert all(r.text == shared for r in result if r.doc_id is None)  # null sorts first


def test_empty_table(docs):
    assert deduplicate(docs([])).collect() == []


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_force({r.doc_id: r.text for r in rows})
    for r in REGISTRY["op7_line_windows"](spark, SF_DIR).collect():
        text, n, gone = expected[r.doc_id]
        assert (r.n_lines, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(text.encode()).hexdigest())
