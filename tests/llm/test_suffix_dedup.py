from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from review_signals.llm import suffix_dedup
from review_signals.llm.deep_shallow import equal_suffixes
from review_signals.llm.queries import REGISTRY
from review_signals.llm.suffix_dedup import Repeats, deduplicate

from .conftest import SF_DIR


def brute_force(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    result = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone[:-1]])
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(r) else 0
        result.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return result


def found(frame):
    return sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in frame.collect())


def odd_texts(generator):
    letters = "abcdé "
    prose = lambda n: "".join(generator.choices(letters, k=n))
    passage, long = prose(260), prose(900)
    texts = [prose(300) for _ in range(6)]
    texts += [prose(generator.randrange(90)) + passage[generator.randrange(40):] + prose(generator.randrange(90)) for _ in range(25)]
    for _ in range(20):
        edited = list(long)
        for _ in range(generator.randrange(6)):
            edited[generator.randrange(len(edited))] = "Z"
        texts.append("".join(edited))
    texts += [long, long, None, "", "x" * 199, "x" * 200, "y" * 201, "ab" * 300, "abc " * 90 + prose(50), passage[:200], passage[:199] + "#",
              "é" * 100, "é" * 100 + "!", prose(50) * 5]
    return texts


@pytest.mark.parametrize("repeats", [Repeats(), Repeats(hot=3), Repeats(hot=2, gram=8, max_broadcast=0)])
def test_equals_brute_force(docs, repeats):
    texts = odd_texts(random.Random(repeats.hot))
    assert found(deduplicate(docs(enumerate(texts)), repeats)) == sorted(brute_force(texts))


def test_short_repeats(docs):
    texts = odd_texts(random.Random(9))
    got = found(deduplicate(docs(enumerate(texts)), Repeats(length=24, gram=9, hot=4)))
    assert got == sorted(brute_force(texts, 24))


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = dict(zip((r.doc_id for r in rows), brute_force([r.text for r in rows]), strict=True))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in REGISTRY["op8_suffix_dedup"](spark, SF_DIR).collect()}
    assert got == expected


def test_repeated_rows_null_ids_and_clashing_columns(spark, docs):
    text = "".join(chr(97 + i * i % 23) for i in range(260))
    frame = spark.createDataFrame([(1, text), (1, text), (None, text + "?"), (None, "q" * 10)], "doc_id long, text string")
    frame = frame.selectExpr("*", "1 as node", "2 as spans", "3 as kept")
    assert found(deduplicate(frame)) == sorted(brute_force([text, text, text + "?", "q" * 10]))
    assert deduplicate(docs([])).collect() == []


def test_deep_shallow_sort_finds_equal_suffixes():
    generator = np.random.default_rng(4)
    data = np.concatenate([np.tile(generator.integers(97, 99, 70), 6), generator.integers(97, 99, 600)]).astype(np.uint8)
    starts = generator.integers(0, len(data) - 60, 700)
    groups = generator.integers(0, 3, 700)
    for shallow in (8, 16, 64):
        leader = equal_suffixes(data, starts, groups, 48, shallow)
        keys = [(int(g), data[s:s + 48].tobytes()) for s, g in zip(starts, groups, strict=True)]
        for i, j in enumerate(leader.tolist()):
            assert keys[i] == keys[j]
        assert len(set(leader.tolist())) == len(set(keys))


def test_repeated_rows_are_sorted_once(spark, monkeypatch):
    """The contexts that are sorted don't grow with the copies of a row, whether the id is null or repeated."""
    generator, sorted_rows, plain = random.Random(8), [], suffix_dedup.sort_contexts
    prose = lambda n: "".join(generator.choices("abcdefgh ", k=n))
    shared, first, second = prose(400), prose(900), prose(900)
    texts = [(None, first + shared), (7, second + shared), (8, prose(500) + shared + prose(300))]

    def counting(contexts, repeats):
        sorted_rows.append(contexts.count())
        return plain(contexts, repeats)

    monkeypatch.setattr(suffix_dedup, "sort_contexts", counting)
    for copies in (2, 300):
        rows = [*texts[:2] * copies, texts[2]]
        got = found(deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
        assert got == sorted(brute_force([t for _, t in rows]))
    assert sorted_rows[0] == sorted_rows[1]


def test_very_long_text(docs):
    generator = random.Random(9)
    long = "".join(generator.choices("abcdefgh ", k=300_000))
    texts = [long + long[1000:1300], long[5000:5250], "z" * 150_000]
    got = found(deduplicate(docs(enumerate(texts))))
    assert got == sorted(brute_force(texts))
