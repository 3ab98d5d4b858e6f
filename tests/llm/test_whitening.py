"""Whitened embeddings against a plain eigenvalue routine, and on odd vectors."""

import numpy as np
import pytest

from presscheck.llm import whitening
from presscheck.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain(vectors):
    x = np.floor(256 * np.array(vectors, dtype=float))
    distinct = np.unique(x, axis=0)
    sums, n = distinct.sum(0), len(distinct)
    values, axes = np.linalg.eigh(np.cov(distinct.T, bias=True).reshape(x.shape[1], -1))
    return x, sums, n, values[::-1], axes[:, ::-1]


def test_query_equals_a_plain_program(spark):
    table = [r for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    x, sums, n, values, axes = plain([r.embedding for r in table])
    rows = {(r.vec_id, r.component): r for r in QUERIES["op12_whitening"](spark, SMALL).collect()}
    assert len(rows) == 4 * len(table)
    for k in range(4):
        want = (x - sums / n) @ axes[:, k] / np.sqrt(values[k])
        got = np.array([rows[r.vec_id, k + 1].whitened for r in table])
        assert np.abs(got - want * np.sign(got[0] * want[0])).max() < 1e-9
    for r, row in zip(table, x):
        found = rows[r.vec_id, 1]
        assert found.n == n and found.deviation == int(((n * row - sums) ** 2).sum())
        assert found.explained == pytest.approx(values[0] / values.sum(), rel=1e-9) and found.identity_error < 1e-9


@pytest.mark.parametrize(
    "spectrum", [[5.0, 4, 3, 2, 1], [3.0, 3, 3, 3, 1], [9.0, 9 - 1e-12, 9 - 1e-8, 1, 1], [1.0] * 5, [2.0, 0, 0, 0, 0], [0.0] * 5, [7.0, 7, 1e-9, 1e-9, 0]]
)
def test_leading_eigenvectors(spectrum):
    turn = np.linalg.qr(np.random.default_rng(1).normal(size=(5, 5)))[0]
    matrix = turn @ np.diag(spectrum) @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading(matrix, 4)
    assert values == pytest.approx(sorted(spectrum, reverse=True)[:4], abs=1e-12)
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-10
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12


def test_counts_are_those_of_the_eigenvalues():
    generator = np.random.default_rng(4)
    for size in (1, 2, 3, 8, 30):
        half = generator.normal(size=(size, size))
        matrix = half + half.T
        values = np.linalg.eigvalsh(matrix)
        for shift in [*generator.normal(size=10) * 3, 0.0]:
            assert whitening.count_above(matrix, shift) == (values > shift).sum()
    swapped = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert [whitening.count_above(swapped, s) for s in (-2, 0, 2)] == [2, 1, 0]


def test_odd_vectors(spark):
    rows = [
        (1, [0.5, 0.25, 1.0]), (1, [0.5, 0.25, 1.0]), (2, [-0.5, 0.0, 0.125]), (None, [0.1, -0.0, 2.0]), (3, None), (4, [0.1, None, 0.2]),
        (5, [float("nan"), 0.0, 0.0]), (6, [float("inf"), 0.0, 0.0]), (7, [1e30, 0.0, 0.0]), (8, [1.0]), (9, []),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS n", "'a' AS x", "2 AS component")
    found = whitening.whiten(frame).collect()
    kept = [1, 1, 2, None, 8, 9]
    assert sorted((r.vec_id or 0, r.component) for r in found) == sorted((k or 0, c) for k in kept for c in (1, 2, 3))
    x, sums, n, values, _ = plain([r[1] for r in rows[:4]] + [[1.0, 0, 0], [0.0, 0, 0]])
    assert n == 5 and {r.n for r in found} == {5}
    assert {r.deviation for r in found if r.vec_id == 1} == {int(((n * x[0] - sums) ** 2).sum())}
    assert found[0].identity_error < 1e-9
    assert whitening.whiten(frame.limit(0)).isEmpty() and whitening.whiten(frame.where("vec_id = 3")).isEmpty()


def test_vectors_without_variance(spark):
    frame = spark.createDataFrame([(i, [0.5, 1.0]) for i in range(5)], "vec_id long, embedding array<float>")
    found = whitening.whiten(frame).collect()
    assert len(found) == 10
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {(1, 0, 0.0, 0.0, 0.0)}


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float((i * 7919) % 1000) * 1e5, float(i) * 3e6]) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r.deviation for r in whitening.whiten(frame).where("component = 1").collect()}
    x = [[int(256 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    for i, v in enumerate(x):
        exact = sum((200 * c - s) ** 2 for c, s in zip(v, sums))
        assert found[i] == (exact if exact < 1 << 63 else None)
