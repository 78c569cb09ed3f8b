"""Whitening against exact fractions and a plain covariance."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from daylake.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, n int, component string, total int, size int"


def plain(vectors):
    """x, its covariance as exact fractions, and the exact deviations."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(dims)]
    centred = [[n * row[d] - sums[d] for d in range(dims)] for row in x]
    cov = [[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(dims)] for i in range(dims)]
    return x, sums, np.array(cov), [sum(c * c for c in r) for r in centred]


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e3, 1e7])
def test_polarised_covariance_is_exact(scale):
    rng = np.random.default_rng(int(math.log10(scale)) + 9)
    vectors = rng.normal(size=(37, 5)) * scale + 3 * scale
    x, sums, cov, deviation = plain(vectors)
    numbers = np.array(x, np.int64)
    squares = [int(v) for v in whitening.polarised(numbers - np.array(whitening.centre_of(37, sums)))]
    assert np.array_equal(whitening.covariance(37, sums, squares), cov)
    model = whitening.Fit(37, sums, np.zeros((0, 5)), np.zeros(0), 0.0)
    assert whitening.deviations(model, numbers) == deviation


def check(rows, vectors, ids):
    x, sums, cov, deviation = plain(vectors)
    n, k = len(x), min(8, len(sums))
    values, parts = np.linalg.eigh(cov)
    values, parts = values[::-1][:k], parts.T[::-1][:k]
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == n * k
    white = np.array([[got[i, c].whitened for c in range(1, k + 1)] for i in ids])
    for c in range(k):
        centred = np.array(x) - np.array([float(Fraction(s, n)) for s in sums])
        want = centred @ parts[c] / math.sqrt(values[c])
        assert min(np.abs(white[:, c] - want).max(), np.abs(white[:, c] + want).max()) < 1e-8
    error = np.abs(white.T @ white / n - np.eye(k)).max()
    for i, row in zip(ids, deviation, strict=True):
        for c in range(k):
            r = got[i, c + 1]
            assert (r.n, int(r.deviation)) == (n, row)
            assert abs(r.explained / (values[c] / np.trace(cov)) - 1) < 1e-9
            assert abs(r.identity_error - error) < 1e-9 and r.identity_error < 1e-9


def test_query_equals_plain_python(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").collect()
    check(queries.op12_whitening(spark, small).collect(), [r.embedding for r in table], [r.vec_id for r in table])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2, 3) for i, v in rows], SCHEMA)


def test_unusable_vectors_are_left_out(spark):
    rng = np.random.default_rng(4)
    good = [(i, (rng.normal(size=3) * 5).tolist()) for i in range(40)]
    bad = [
        (100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 1.0, 2.0]), (104, []),
        (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0]), (107, [1.0, 2.0, 3.0, 4.0]),
    ]
    rows = whitening.whitened(frame(spark, good + bad).repartition(6)).collect()
    check(rows, [v for _, v in good], [i for i, _ in good])


def test_repeats_nulls_and_ties(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [5.0, 5.0]), (2, [5.0, 5.0])]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert len(got) == 12 and sum(r.vec_id is None for r in got) == 4 and {r.n for r in got} == {6}
    assert max(r.identity_error for r in got) < 1e-9
    # A dimension that never varies has no component of its own.
    flat = whitening.whitened(frame(spark, [(i, [float(i), 3.0, float(i)]) for i in range(9)])).collect()
    assert len(flat) == 9 and {r.explained for r in flat} == {1.0}


def test_tables_without_variance_give_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whitened(frame(spark, rows))
        assert got.count() == 0
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_64_bits(spark):
    rows = [(0, [3.0e9]), (1, [-3.0e9]), (2, [1.0])]
    got = {r.vec_id: int(r.deviation) for r in whitening.whitened(frame(spark, rows)).collect()}
    assert got == dict(enumerate(plain([v for _, v in rows])[3])) and max(got.values()) > 1 << 63
