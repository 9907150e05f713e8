from __future__ import annotations

import importlib
import re

import numpy as np
from .test_jaccard_join import brute_force as components_of
from .test_line_windows import brute_force as lines_without
from .test_spaced_seeds import brute_force as leaks_of
from .test_vector_packing import check_pieces

import corpus_pipeline

from .conftest import SF_DIR

STAGES = dict(corpus_pipeline.STAGES)


def as_dict(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_over_a_whole_table(spark):
    """Each stage, on what the one before it kept, against a plain version."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").coalesce(4)
    columns = docs.columns
    benchmark = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    texts = as_dict(docs)

    kept = corpus_pipeline.staged(STAGES["quality_rules"](spark, docs, SF_DIR), "t")
    word = re.compile(r"[^\x20\x09-\x0D]+")

    def base_failed(text):
        words = word.findall(text)
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        again = {i + s for i, g in enumerate(grams) if grams.count(g) > 1 for s in range(5)} if len(set(grams)) < len(grams) else ()
        return len(words) < 10 or 100 * len(again) > 20 * len(words)

    assert kept.columns == columns
    # too few labels here for any cutoff: only the base rule rejects
    assert as_dict(kept) == {i: t for i, t in texts.items() if not base_failed(t)}

    lines = corpus_pipeline.staged(STAGES["line_dedup"](spark, kept, SF_DIR), "t")
    assert lines.columns == columns
    plain = lines_without(as_dict(kept))
    assert as_dict(lines) == {i: new for i, (new, n, gone) in plain.items() if not n or gone < n}
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    unique = corpus_pipeline.staged(STAGES["jaccard_dedup"](spark, lines, SF_DIR), "t")
    assert unique.columns == columns
    groups = components_of(as_dict(lines))
    assert as_dict(unique) == {i: t for i, t in as_dict(lines).items() if groups[i][1] == i}

    clean = corpus_pipeline.staged(STAGES["decontaminate"](spark, unique, SF_DIR), "t")
    assert clean.columns == columns
    leaks = {i for i, _ in leaks_of(as_dict(unique), benchmark)}
    assert as_dict(clean) == {i: t for i, t in as_dict(unique).items() if i not in leaks}
    assert check_pieces(STAGES["packing"](spark, clean, SF_DIR).collect(), as_dict(clean)) < 0.01


def test_run_equals_the_stages_by_hand(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, SF_DIR), "t")
    assert check_pieces(rows.collect(), as_dict(docs)) < 0.01


def test_repeated_rows_and_nulls(spark):
    words = np.array([f"w{i}" for i in range(400)])
    text = " ".join(words[:60])
    rows = [(1, text), (1, text), (2, text), (3, " ".join(words[100:190])), (None, " ".join(words[200:290])), (None, None), (None, "a b")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("quality_rules", "line_dedup", "jaccard_dedup", "decontaminate"):
        docs = corpus_pipeline.staged(STAGES[name](spark, docs, SF_DIR), "t")
    assert sorted((r.doc_id or 0, len(r.text)) for r in docs.collect()) == sorted([(1, len(text)), (3, len(rows[3][1])), (0, len(rows[4][1]))])


def near_copies(texts, words=5, percent=80):
    """The smallest id of each document's component, by comparing all pairs that share a shingle."""
    word, lower = re.compile(r"[^\x20\x09-\x0D]+"), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, holders, root = {}, {}, {i: i for i in texts}
    for i, text in texts.items():
        found = word.findall((text or "").translate(lower))
        sets[i] = {tuple(found[k:k + words]) for k in range(max(1, len(found) - words + 1))} if found else set()
        for shingle in sets[i]:
            holders.setdefault(shingle, []).append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in {(a, b) for held in holders.values() for k, a in enumerate(held) for b in held[k + 1:]}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in texts}


def test_near_copies_are_those_of_five_words_and_0_8(spark, docs):
    words = [f"w{i}" for i in range(120)]
    frame = docs([(1, " ".join(words[:100])), (2, " ".join(words)), (3, " ".join(words[:80] + [f"x{i}" for i in range(30)]))])
    assert set(as_dict(STAGES["jaccard_dedup"](spark, frame, SF_DIR))) == {1, 3}  # 96 / 116 = 0.828
    frame = spark.read.parquet(f"{SF_DIR[:-5]}0.01/documents.parquet").coalesce(4)
    texts = as_dict(frame)
    roots = near_copies(texts)
    assert as_dict(STAGES["jaccard_dedup"](spark, frame, SF_DIR)) == {i: t for i, t in texts.items() if roots[i] == i}


def test_one_of_each_group_stays_with_repeated_and_null_ids(spark):
    def near(name):
        words = [f"{name}{i}" for i in range(120)]
        return [" ".join(words[:n]) for n in (100, 105, 110)]

    a, b, c, d = map(near, "abcd")
    rows = [(1, a[0]), (1, a[1]), (1, a[1]), (None, b[0]), (None, b[1]), (None, b[2]), (None, c[0]), (7, c[1]), (7, c[2]), (8, d[0]), (7, d[1])]
    rows += [(None, None), (None, ""), (9, "")]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in STAGES["jaccard_dedup"](spark, frame, SF_DIR).collect()]
    groups = [(i, t[0]) for i, t in kept if t]
    assert sorted(groups, key=str) == [(1, "a"), (7, "c"), (7, "d"), (None, "b")]
    assert {(i, t) for i, t in kept if not t} == {(None, None), (None, ""), (9, "")}


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF_DIR), "t")
    assert docs.collect() == []


def test_entry_lists_the_pipeline():
    entry = importlib.import_module("__spark_entry__")
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
