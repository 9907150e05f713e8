from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from review_signals.llm import merge_encoding
from review_signals.llm.merge_encoding import Encoder, digest, encode_decode
from review_signals.llm.queries import REGISTRY
from review_signals.llm.tokens import vocabulary

from .conftest import SF_DIR

MODEL = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return Encoder(MODEL)


ALPHABETS = ["ab ", " \n\t▁", "abcdefghijklmnopqrstuvwxyz ", "".join(map(chr, range(32, 0x3000))), "etaoinshr", "  the=-_()", "a😀é中文 \x00", "0123456789.,"]


def test_random_texts_have_the_ids_of_the_library(own, library):
    generator = random.Random(1)
    for _ in range(4000):
        text = "".join(generator.choices(generator.choice(ALPHABETS), k=generator.randrange(80)))
        assert own.encode(text).tolist() == library.encode(text), text


def test_random_ids_show_the_text_of_the_library(own, library):
    generator = random.Random(2)
    for _ in range(4000):
        ids = [generator.choice((generator.randrange(300), generator.randrange(32000), generator.randrange(3, 259))) for _ in range(generator.randrange(12))]
        assert own.decode(np.array(ids, np.int32)) == library.decode(ids), ids


def test_backtracking_equals_the_merges(own):
    generator = random.Random(3)
    for _ in range(1500):
        word = "".join(generator.choices(generator.choice(["the", "abcdeinorst", "▁a", "=-"]), k=generator.randrange(2, 40)))
        assert [own.names[k] for k in own.pieces(word, *own.block(word, 0))] == own.merged(word)


@pytest.mark.parametrize("block", [5, 64])
def test_blocks_change_nothing(library, monkeypatch, block):
    monkeypatch.setattr(merge_encoding, "BLOCK", block)
    monkeypatch.setattr(merge_encoding, "TEXT_BLOCK", 3 * block)
    monkeypatch.setattr(merge_encoding, "REMEMBERED", 20)
    coder, generator = Encoder(MODEL), random.Random(block)
    for letters in ("aab", " ", "etaoinshr", "é", "= "):
        text = "".join(generator.choices(letters, k=700))
        assert coder.encode(text).tolist() == library.encode(text)


def test_long_words_take_time_in_proportion(own, library):
    for letters in ("a", "etaoinshr", " "):
        text = "".join(random.Random(4).choices(letters, k=60_000))
        assert own.encode(text).tolist() == library.encode(text)


def test_other_models_are_refused(tmp_path):
    with open(MODEL, "rb") as file:
        raw = file.read()
    other = tmp_path / "other.model"
    other.write_bytes(raw + b"\x12\x02\x18\x01")  # the last value counts: a unigram model
    with pytest.raises(ValueError, match="merge-type"):
        Encoder(str(other))


def test_rows(spark, library):
    texts = [None, "", " ", "a", "Hello  World\n", "▁x", "x" * 5000, "long text, with words " * 20_000, "a", "﻿　"]
    rows = [(i if i % 4 else None, t, 1) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    found = sorted(((r.ids, r.decoded) for r in encode_decode(frame, MODEL).collect()), key=str)
    assert found == sorted(((library.encode(t or ""), library.decode(library.encode(t or ""))) for t in texts), key=str)
    assert sorted(digest(encode_decode(frame, MODEL)).dtypes) == [
        ("decoded_sha256", "string"), ("doc_id", "bigint"), ("ids_sha256", "string"), ("n_tokens", "bigint")]


def test_empty_table(docs):
    assert encode_decode(docs([]), MODEL).collect() == []


def test_whole_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = REGISTRY["op11_backtracking_encoding"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "")
        expected = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), library.decode(ids))]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *expected)


def test_ids_are_numbers_of_the_vocabulary(own):
    assert np.array_equal(np.unique(own.encode("a\n")), np.sort(own.encode("a\n")))
