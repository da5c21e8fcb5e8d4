"""Whitening: eigenvectors against a dense solver, exact deviations, odd input."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm.whitening import Centre, damped, leading, whiten

SCHEMA = "vec_id bigint, embedding array<float>"


def spectrum(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * values) @ q.T


def check_leading(v, count):
    calls = [0]

    def multiply(q):
        calls[0] += 1
        return v @ q

    values, q = leading(multiply, len(v), count)
    right = np.linalg.eigvalsh(v)[::-1][: len(values)]
    assert np.allclose(values, right, rtol=0, atol=1e-12 * max(right[0], 1))
    assert np.abs(q.T @ q - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ q - q * values).max() <= 1e-10 * max(right[0], 1)
    return calls[0]


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 2, 200),  # hardly any gaps
        np.r_[np.full(12, 5.0), np.linspace(0, 1, 100)],  # twelve equal ones for eight places
        np.r_[1e12, 1e6, 1.0, np.zeros(60)],  # fewer than eight
        np.r_[3.0, 2.0, 1.0],  # fewer dimensions than places
        np.zeros(40),
        np.geomspace(1, 1e-9, 90),
    ],
)
def test_leading_eigenvectors(values):
    check_leading(spectrum(values), 8)


def test_filter_damps_the_unwanted_spectrum():
    values = np.r_[4.0, 3.0, np.linspace(0, 2, 50)]
    v = np.diag(values)
    q = np.eye(52)
    out = np.abs(np.diag(damped(lambda x: v @ x, q, v @ q, 2.0, 4.0)))
    assert out[2:].max() < 1e-3 * out[1] and out[1] < out[0]


def dense(rows):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in r] for r in rows], np.int64)
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    return n, ((n * x - s) ** 2).sum(axis=1), c, e[::-1], q[:, ::-1]


def by_vector(found):
    out = {}
    for r in found:
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def test_against_a_dense_solver(spark):
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((300, 40)) @ np.diag(np.geomspace(1, 0.01, 40))
    table = [(i, [float(v) for v in r]) for i, r in enumerate(rows)]
    damaged = [(900, None), (901, [None] * 40), (902, [math.nan] * 40), (903, [math.inf] * 40), (904, []),
               (905, [1.0] * 39), (906, [1e30] * 40)]
    docs = spark.createDataFrame(table + damaged, SCHEMA).repartition(2)
    for name in ("x", "width", "n", "cell", "part", "component"):
        docs = docs.withColumn(name, F.lit("?"))
    found = whiten(docs).collect()
    n, deviation, c, e, q = dense([r for _, r in table])
    rows = by_vector(found)
    assert sorted(rows) == list(range(300)) and all(sorted(r) == list(range(1, 9)) for r in rows.values())
    assert all(r.n == n and r.identity_error < 1e-10 for r in found)
    got = np.array([[rows[i][k].whitened for k in range(1, 9)] for i in range(300)])
    right = (c @ q[:, :8]) / np.sqrt(e[:8])
    signs = np.sign((got * right).sum(axis=0))
    assert np.abs(got * signs - right).max() < 1e-9
    assert [rows[i][1].deviation for i in range(300)] == deviation.tolist()
    explained = [rows[0][k].explained for k in range(1, 9)]
    assert np.allclose(explained, e[:8] / e.sum(), rtol=1e-10)


def test_copies_and_repeated_ids(spark):
    rng = random.Random(3)
    copy = [rng.random() for _ in range(5)]
    rows = [(1, copy)] * 200 + [(None, [rng.random() for _ in range(5)]) for _ in range(50)]
    found = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 250 * 5 and found[0].n == 250
    assert len({(r.component, r.whitened) for r in found if r.vec_id == 1}) == 5
    assert found[0].identity_error < 1e-10


def test_vanishing_components_are_left_out(spark):
    flat = [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)]
    found = whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r.component for r in found} == {1} and abs(found[0].explained - 1) < 1e-12
    equal = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], SCHEMA)
    assert whiten(equal).collect() == []
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []


def test_exact_numbers_of_any_size():
    x = np.array([[1 << 50, 5], [3, -(1 << 50)], [7, 9]])
    sums = [int(v) for v in x.sum(axis=0)]
    centre = Centre(3, np.array([s // 3 for s in sums]), np.array([s % 3 for s in sums]))
    exact = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    assert centre.deviations(x) == [v if v < 1 << 63 else None for v in exact]
    small = x % 1000
    sums = [int(v) for v in small.sum(axis=0)]
    centre = Centre(3, np.array([s // 3 for s in sums]), np.array([s % 3 for s in sums]))
    assert centre.deviations(small) == [
        sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in small
    ]
