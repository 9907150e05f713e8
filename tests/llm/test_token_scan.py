from __future__ import annotations

import os
import random

import numpy as np
import pytest

from review_signals.llm import token_scan
from review_signals.llm.queries import REGISTRY
from review_signals.llm.token_scan import BLOCKS, count_tokens, read_token_files
from review_signals.llm.tokens import END_OF_TEXT, vocabulary

from .conftest import SF_DIR
from .test_vector_packing import plain_tokenizer

END = 7


def brute_force(files):
    """(file, document, start, tokens, closed) of every document."""
    rows = []
    for file_id, ids in files.items():
        start, number = 0, 0
        for at, token in enumerate(ids):
            if token == END:
                rows.append((file_id, number, start, at + 1 - start, True))
                start, number = at + 1, number + 1
        if start < len(ids):
            rows.append((file_id, number, start, len(ids) - start, False))
    return sorted(rows)


def found(frame):
    return sorted((r.file_id, r.doc_number, r.start, r.n_tokens, r.closed) for r in frame.collect())


def flat_files(generator):
    files = {i: generator.choices([1, 2, END] if i % 2 else range(60), k=generator.randrange(400)) for i in range(12)}
    return files | {50: [], 51: [END], 52: [END, END], 53: [1] * 100, 54: [1] * 33 + [END]}


@pytest.mark.parametrize("size", [1, 5, 64, 1000])
def test_equals_brute_force_for_any_block_size(spark, size, monkeypatch):
    monkeypatch.setattr(token_scan, "SEGMENT", 3)
    files = flat_files(random.Random(size))
    blocks = [(f, b, np.array(ids[low:low + size], "<u2").tobytes()) for f, ids in files.items()
              for b, low in enumerate(range(0, len(ids), size))] + [(60, 0, None), (60, 1, b"")]
    random.Random(1).shuffle(blocks)
    frame = spark.createDataFrame(blocks, BLOCKS).selectExpr("*", "1 as ends", "2 as segment")
    assert found(count_tokens(frame, END)) == brute_force(files)


def test_flat_files_on_disk(spark, tmp_path):
    files = flat_files(random.Random(4))
    for number, ids in files.items():
        np.array(ids, "<u2").tofile(os.path.join(tmp_path, f"{number}.bin"))
    counted = [row[1:] for row in found(count_tokens(read_token_files(spark, str(tmp_path), 16), END))]
    assert sorted(counted) == sorted(row[1:] for row in brute_force(files))


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], BLOCKS)).collect() == []


def test_whole_table(spark):
    tokenizer = plain_tokenizer()
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted((r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1) for r in rows)
    assert sorted(tuple(r) for r in REGISTRY["op5_separator_scan"](spark, SF_DIR).collect()) == expected


def test_documents_with_nulls_repeats_and_the_separators_name(spark):
    rows = [(1, None), (2, ""), (3, "<|endoftext|> a"), (3, "<|endoftext|> a"), (None, "b"), (4, "word " * 70_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = token_scan.count_documents(frame, vocabulary()).collect()
    tokenizer = plain_tokenizer()
    expected = [(i or 0, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows]
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted(expected)
    assert END_OF_TEXT == 49407
