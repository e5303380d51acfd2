import math
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import whitening as wh
from tessera.llm import whitening_queries

SCHEMA = "vec_id long, embedding array<float>, whitened string, label int"


def brute(rows):
    """(n, x rows, sums, V) by exact fractions."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in r] for r in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    centred = [[r[j] - Fraction(sums[j], n) for j in range(d)] for r in x]
    cov = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(d)] for i in range(d)])
    return n, x, sums, np.array(centred, "f8"), cov


def check(spark, rows, ids=None):
    df = spark.createDataFrame([(i, [float(c) for c in r], "kept", 1) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    n, x, sums, y, cov = brute(rows)
    got = whitening_queries.components(df).collect()
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(32, int((values > 1e-10 * values[0]).sum()))
    assert {(r.vec_id, r.component) for r in got} == {(i, c + 1) for i in range(n) for c in range(count)}
    table = np.zeros((n, count))
    for r in got:
        assert r.n == n and r.deviation == sum((n * v - s) ** 2 for v, s in zip(x[r.vec_id], sums, strict=True))
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-8)
        assert 0 <= r.identity_error < 1e-9
        table[r.vec_id, r.component - 1] = r.whitened
    want = y @ vectors[:, :count] / np.sqrt(values[:count])
    for c in range(count):
        apart = min(abs(values[c] - values[o]) for o in range(len(values)) if o != c) if len(values) > 1 else values[0]
        if apart > 1e-6 * values[0]:  # else the vector isn't determined
            sign = np.sign(table[:, c] @ want[:, c])
            assert np.abs(table[:, c] * sign - want[:, c]).max() < 1e-6


def test_equals_the_eigenvectors(spark):
    rng = np.random.default_rng(3)
    check(spark, rng.normal(size=(90, 6)) @ rng.normal(size=(6, 6)))
    check(spark, rng.normal(size=(60, 40)) * np.linspace(0.2, 40, 40) + 900)


def test_ill_conditioned_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(4)
    a = rng.integers(-9_000, 9_000, (80, 3)).astype("f8")
    check(spark, np.column_stack([a, a[:, 0], np.full(80, 5.0), a[:, 1] + rng.integers(0, 2, 80) / 64]))
    check(spark, rng.normal(size=(5, 12)))  # fewer rows than dimensions


def test_factors_compose_to_the_gram_matrix():
    rng = np.random.default_rng(5)
    y = rng.normal(size=(200, 8)) * 10.0 ** -np.arange(8)
    q, r = y, np.eye(8)
    for step in range(3):
        f = wh.factor(q.T @ q, len(y), not step)
        q, r = wh.solved(q, f), f @ r
    assert np.abs(q.T @ q - np.eye(8)).max() < 1e-13
    assert np.abs(q @ r - y).max() < 1e-13
    assert np.allclose(np.linalg.svd(r)[1], np.linalg.svd(y)[1], rtol=1e-9)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], "a", 1), (2, None, None, None), (3, [1.0, None], "a", 1), (4, [nan, 1.0], "a", 1), (5, [1.0, -inf], "a", 1), (6, [], "a", 1),
            (7, [1.0, 2.0, 3.0], "a", 1), (8, [4.0, -2.0], "a", 1), (8, [4.0, -2.0], "a", 1), (None, [0.5, 0.25], None, None), (9, [3e38, 1.0], "a", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = whitening_queries.components(df).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == sorted((v is None, v or 0, c) for v in (1, 8, 8, None) for c in (1, 2))
    assert {r.n for r in got} == {4}
    carried = wh.transform(df, wh.fit(df))
    assert carried.columns == ["vec_id", "label", "whitened", "deviation"] and carried.count() == 4


def test_empty_equal_and_single_rows(spark):
    for rows in ([], [(1, [1.0, 2.0], None, None)], [(1, [1.0, 2.0], None, None)] * 5, [(1, None, None, None)]):
        assert whitening_queries.components(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_deviation_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(i, [float(i % 2) * 2.0 ** 39], None, None) for i in range(4)], SCHEMA)
    assert {r.deviation for r in whitening_queries.components(df).collect()} == {None}
