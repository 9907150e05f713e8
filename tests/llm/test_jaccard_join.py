from __future__ import annotations

from pyspark.sql import functions as F

import random
import re
from collections import Counter

import pytest

from review_signals.llm.components import components
from review_signals.llm import jaccard_join
from review_signals.llm.jaccard_join import Join, cost_boundary, similar_components
from review_signals.llm.queries import REGISTRY

from .conftest import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3)))


def brute_force(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    shared = Counter()
    for holders in index.values():
        for k, a in enumerate(holders):
            for b in holders[k + 1:]:
                shared[a, b] += 1
    for (a, b), both in shared.items():
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(sets[i]), find(i)) for i in texts}


def found(frame):
    return {row.doc_id: (row.n_shingles, row.component_id) for row in frame.collect()}


def edited(words, edits, generator):
    words = list(words)
    for _ in range(edits):
        words[generator.randrange(len(words))] = f"x{generator.randrange(10**6)}"
    return words


@pytest.mark.parametrize("join", [Join(), Join(hot=3), Join(hot=8, list_cost=60), Join(hot=5, max_hot=10, max_ids=0)])
def test_equals_brute_force(docs, join):
    generator = random.Random(join.hot)
    texts, line = [], [f"license{i}" for i in range(30)]
    for size in [1, 2, 3, 4, 5, 9, 12, 16, 22, 40, 90, 300]:
        base = [f"w{generator.randrange(300)}" for _ in range(size)]
        for copy in range(18):
            words = edited(base, generator.choice([0, 0, 1, 2, 3, 8]) if size > 3 else 0, generator)
            texts.append(" ".join(words[generator.randrange(2):] or words))
        for _ in range(6):
            texts.append(" ".join(line + [f"w{generator.randrange(10**6)}" for _ in range(size)]))
    texts += [None, "", " \n\t", "A b C d e", "a B c D e", "same same same same same same"]
    by_id = {7 * i + 3: t for i, t in enumerate(texts)}
    assert found(similar_components(docs(by_id.items()), join)) == brute_force(by_id)


def test_whole_table(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    assert found(REGISTRY["op10_jaccard_join"](spark, SF_DIR)) == brute_force(texts)


def test_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "z z y"), (2, None), (None, None)]
    got = sorted(map(str, similar_components(spark.createDataFrame(rows, "doc_id long, text string")).drop("text_key").collect()))
    assert got == sorted([
        "Row(doc_id=5, n_shingles=3, component_id=5)", "Row(doc_id=5, n_shingles=3, component_id=5)",
        "Row(doc_id=None, n_shingles=3, component_id=5)", "Row(doc_id=None, n_shingles=1, component_id=None)",
        "Row(doc_id=2, n_shingles=0, component_id=2)", "Row(doc_id=None, n_shingles=0, component_id=None)"])


def test_empty_table_and_clashing_columns(docs):
    assert similar_components(docs([])).collect() == []
    frame = docs([(1, "a b c d"), (2, "a b c d")]).selectExpr("*", "1 as node", "2 as n", "3 as component_id")
    assert found(similar_components(frame)) == {1: (1, 1), 2: (1, 1)}


def test_boundary_weighs_subsets_against_lists():
    assert cost_boundary({5: 100}, Join()) > 5
    assert cost_boundary({24: 100}, Join()) <= 24
    assert cost_boundary({}, Join()) == 1


def test_components_of_chains_and_stars(spark):
    generator = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(900, 900)]
    links = [pair if generator.random() < 0.5 else pair[::-1] for pair in links]
    roots = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert roots == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def test_repeated_rows_are_one_node(spark, monkeypatch):
    """Rows without an id and with one text, and rows that repeat an id, bring one row each to every later step."""
    words = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(words))] * 500 + [(7, " ".join([*words[:57], "x"]))] * 500 + [(8, " ".join([*words[:58], "y"]))]
    verified, plain = [], jaccard_join.verify

    def counting(pairs, sets, join):
        joined = pairs.join(sets.select(F.col("node").alias("a")), "a").join(sets.select(F.col("node").alias("b")), "b")
        verified.append(joined.count())
        return plain(pairs, sets, join)

    monkeypatch.setattr(jaccard_join, "verify", counting)
    found = jaccard_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(found) == 1001 and {r.component_id for r in found} == {7}
    assert sum(verified) <= 6
