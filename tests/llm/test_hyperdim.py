from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from review_signals.llm import hyperdim
from review_signals.llm.text_arrays import Texts
from review_signals.llm.hyperdim import Encoder, Profile, learn, predict
from review_signals.llm.queries import REGISTRY
from review_signals.llm.text_arrays import as_texts

TEXTS = ["the cat, sat", "", None, "...", " Été 12 là", "a", "aa..", "..aa", "ΟΔΥΣ straße 😀ok", "x " * 5000]


def plain_vector(text, encoder):
    """n-grams of the text with single border signs, bound and bundled one by one."""
    signs = [0]
    for sign in text or "":
        point = ord(sign.lower()[0]) if sign.isalpha() else 0
        if point or signs[-1]:
            signs.append(point)
    if signs[-1]:
        signs.append(0)
    total = np.zeros(encoder.profile.dimensions)
    for i in range(len(signs) - 2):
        if any(signs[i:i + 3]):
            a, b, c = (encoder._letter_vector(p).astype(int) for p in signs[i:i + 3])
            total += np.roll(a, 2) * np.roll(b, 1) * c
    return total


def test_vectors_equal_the_plain_ones():
    encoder = Encoder(Profile(dimensions=64))
    got = np.concatenate([vectors for _, vectors in encoder.documents(as_texts(pa.array(TEXTS)))])
    for vector, text in zip(got, TEXTS, strict=True):
        assert np.array_equal(vector, plain_vector(text, encoder)), text


def test_memory_of_grams_may_be_small():
    small, large = Encoder(Profile(dimensions=64, remembered=3)), Encoder(Profile(dimensions=64))
    texts = as_texts(pa.array(TEXTS * 60))
    for (_, a), (_, b) in zip(small.documents(texts), large.documents(texts), strict=True):
        assert np.array_equal(a, b)


def test_held_out_accuracy_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = REGISTRY["op9_hyperdimensional_language"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(langs)
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in tested) >= 0.98 * len(tested)


def test_odd_texts(spark):
    rows = [(i, "der hund und die katze", "de") for i in range(20)] + [(i, "the dog and the cat", "en") for i in range(20, 40)]
    rows += [(100, None, "en"), (101, "123 !!", "de"), (102, "the and", None), (102, "the and", None), (None, "und der", "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "2 as held_out").repartition(3)
    prototypes = learn(frame)
    got = {(r.doc_id, r.lang_pred) for r in predict(frame, prototypes).collect() if r.doc_id is None or r.doc_id >= 100}
    assert got == {(100, "und"), (101, "und"), (102, "en"), (None, "de")}
    assert sum(r.doc_id == 102 for r in predict(frame, prototypes).collect()) == 2
    empty = frame.limit(0)
    assert learn(empty) == {} and predict(empty, {}).collect() == []
    assert {(r.lang_pred, r.score) for r in predict(frame, {}).collect()} == {("und", 0.0)}


def test_prototypes_do_not_depend_on_the_layout(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, many = learn(frame.coalesce(1)), learn(frame.repartition(7))
    assert all(np.array_equal(one[lang], many[lang]) for lang in one) and set(one) == set(many)


def test_blocks_of_n_grams_change_nothing(monkeypatch):
    """A text of many different letters: its n-grams are bound in blocks, to the same vector."""
    generator = np.random.default_rng(3)
    text = "".join(map(chr, generator.integers(0x4E00, 0x9FFF, 30_000)))
    raw = np.frombuffer((text + "other").encode(), np.uint8)
    texts = Texts(raw, np.array([0, len(text.encode()), len(raw)]))
    results = []
    for block in (500, 4096, 1 << 30):
        monkeypatch.setattr(hyperdim, "_GRAMS_AT_ONCE", block)
        results.append(np.concatenate([vectors for _, vectors in hyperdim.Encoder(hyperdim.Profile()).documents(texts)]))
    assert results[0].any() and all(np.array_equal(result, results[0]) for result in results)
