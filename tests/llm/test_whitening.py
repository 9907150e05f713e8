from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from review_signals.llm.queries import REGISTRY
from review_signals.llm.whitening import Centre, Whiten, digest, learn, pack, singular_triples, unpack, whiten

from .conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(vector):
    return bool(vector) and all(c is not None and math.isfinite(c) for c in vector)


def brute_force(rows, components=16):
    """Per vector id: n, its exact deviation and its white entries, by an eigensolver on the whole covariance."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and usable(v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(dims)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)] for x in fit])
    variances, vectors = np.linalg.eigh(centred.T @ centred / n)
    variances, vectors = variances[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for i, x in kept:
        row = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)])
        out[i] = (sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)), row @ vectors / np.sqrt(variances))
    return n, out, variances, variances / np.trace(centred.T @ centred / n)


def check(frame, rows, components=16):
    n, expected, _, explained = brute_force(rows, components)
    found = {}
    for r in frame.collect():
        assert r.n == n and r.deviation == expected[r.vec_id][0]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and 0 <= r.identity_error < 1e-9
        found.setdefault(r.component, {})[r.vec_id] = r.whitened
    assert sorted(found) == list(range(1, components + 1))
    for component, white in found.items():
        ours = np.array([white[i] for i in sorted(expected)])
        theirs = np.array([expected[i][1][component - 1] for i in sorted(expected)])
        sign = np.sign(ours @ theirs)
        assert np.abs(ours - sign * theirs).max() < 1e-8


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check(REGISTRY["op13_lanczos_whitening"](spark, SF_DIR), rows)


def test_odd_rows(spark):
    generator = random.Random(1)
    vectors = [[generator.gauss(0, 1 + k) for k in range(6)] for _ in range(80)]
    rows = list(enumerate(vectors + vectors[:20])) + [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (203, [float("nan")] * 6), (204, [float("inf")] * 6)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).selectExpr("*", "1 as n", "2 as packed").repartition(5)
    check(digest(frame, learn(frame)), rows, components=6)
    # a vector of another length has no place among them
    more = frame.unionByName(spark.createDataFrame([(300, [1.0, 2.0], 1, 1, 2)], frame.schema))
    assert {r.vec_id for r in whiten(more, learn(more)).collect()} == {i for i, v in rows if v is not None and usable(v)}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], [(1, None, 1)]])
def test_nothing_to_whiten(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    assert digest(frame, learn(frame)).collect() == []


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2 ** (20 + i)), 1.0 * i, 1e30 if i == 3 else 0.0], 1) for i in range(8)]
    frame = spark.createDataFrame(rows, SCHEMA)
    model = learn(frame)
    x = [[int(min(c, 2.0**46)) * 64 for c in v] for _, v, _ in rows]
    sums = [sum(column) for column in zip(*x, strict=True)]
    expected = {i: sum((8 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in whiten(frame, model).collect()} == expected


def test_packing_is_exact():
    import pyarrow as pa

    vectors = np.array([[0, -128], [127, 5], [128, 0], [-40_000, 3], [2**40, -1]], np.int64)
    assert unpack(pa.array([pack(v) for v in vectors]), 2).tolist() == vectors.tolist()
    assert [len(pack(v)) for v in vectors] == [2, 2, 4, 8, 16]
    assert Centre(5, tuple(map(int, vectors.sum(axis=0)))).deviations(vectors)[0].as_py() == int(
        ((5 * vectors[0].astype(object) - vectors.sum(axis=0).astype(object)) ** 2).sum())


def mirrored(values):
    return np.vstack([np.diag(values), -np.diag(values)])


@pytest.mark.parametrize("matrix", [
    mirrored([9.0, 9, *np.linspace(8, 1, 40)]), mirrored([2.0] * 20 + [1.0] * 10), np.eye(30),
    np.random.default_rng(0).normal(size=(500, 300)) * 0.9 ** np.arange(300),
    np.random.default_rng(0).integers(-3, 4, (300, 3)) @ np.random.default_rng(1).integers(-3, 4, (3, 40)),
    np.random.default_rng(2).normal(size=(4, 50)),
], ids=["pair on top", "many equal", "all equal", "falling", "three", "few rows"])
def test_finds_all_copies_of_a_value(matrix):
    """Equal values, low ranks and fewer rows than dimensions: the values of a full decomposition, with orthonormal vectors."""
    rows = matrix - matrix.mean(axis=0)
    passes = []

    def multiply(vector):
        passes.append(1)
        left = rows @ vector
        return rows.T @ left, float(left @ left)

    values, vectors = singular_triples(multiply, rows.shape[1], 16, Whiten().seed)
    full = np.linalg.svd(rows, compute_uv=False)
    full = full[full > 1e-9 * full[0]][:16]
    assert len(values) == len(full) and np.allclose(values, full, rtol=1e-12)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)
    assert np.allclose(rows.T @ (rows @ vectors.T), vectors.T * values**2, atol=1e-11 * full[0] ** 2)
    assert len(passes) < 2 * rows.shape[1] + 20
