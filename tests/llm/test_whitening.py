"""Whitening against plain exact arithmetic and a library's eigenvalues."""

from fractions import Fraction
from math import floor

import numpy as np
import pytest

from weftline.llm.queries import op13_whitening
from weftline.llm.whitening import count_above, leading_pairs, tridiagonal, whiten

KIND = "vec_id long, embedding array<float>"


def plain(rows):
    """Exact x-vectors, deviations and covariance of the whole finite vectors."""
    kept = [(i, [floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    n, dims = len(kept), len(kept[0][1])
    sums = [sum(x[d] for _, x in kept) for d in range(dims)]
    deviation = {}
    for i, x in kept:
        deviation.setdefault(i, []).append(sum((n * x[d] - sums[d]) ** 2 for d in range(dims)))
    centred = [[Fraction(x[d]) - Fraction(sums[d], n) for d in range(dims)] for _, x in kept]
    covariance = np.array([[float(sum(c[i] * c[j] for c in centred) / n) for j in range(dims)] for i in range(dims)])
    return n, deviation, np.array([[float(v) for v in c] for c in centred]), covariance, [i for i, _ in kept]


def check(rows, found, components=32):
    n, deviation, centred, covariance, ids = plain(rows)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert {(r["vec_id"], r["component"]) for r in found} == {(i, c) for i in ids for c in range(1, k + 1)}
    assert {r["n"] for r in found} == {n}
    cells = {}
    for r in found:
        assert r["deviation"] in deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / covariance.trace(), rel=1e-9)
        assert r["identity_error"] < 1e-9
        cells[r["vec_id"], r["component"]] = r["whitened"]
    for c in range(1, k + 1):
        want = {i: w for i, w in zip(ids, centred @ vectors[:, c - 1] / np.sqrt(values[c - 1]))}
        pairs = np.array([(cells[i, c], w) for i, w in want.items()])
        sign = np.sign(pairs[:, 0] @ pairs[:, 1])
        assert np.abs(pairs[:, 0] - sign * pairs[:, 1]).max() < 1e-6


def test_whole_table_against_exact_arithmetic(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()][:150]
    rows = [(i, v[:7]) for i, v in rows]
    check(rows, whiten(spark.createDataFrame(rows, KIND).repartition(4)).collect())
    assert op13_whitening(spark, folder).groupBy("vec_id").count().filter("count != 32").count() == 0


def test_odd_rows(spark):
    rows = [(k, [0.1 * k, float(k * k % 7), -2.0, float(k % 3)]) for k in range(20)]
    rows += [(3, rows[3][1]), (50, None), (51, [1.0, None, 1.0, 1.0]), (52, [1.0, float("nan"), 0.0, 0.0])]
    rows += [(53, [float("inf"), 0.0, 0.0, 0.0]), (54, []), (None, [1.0, 2.0, 3.0, 4.0])]
    table = spark.createDataFrame(rows, KIND)
    check([r for r in rows if r[1] != []], whiten(table).collect())
    other = spark.createDataFrame([*rows, (60, [1.0, 2.0])], KIND).selectExpr("*", "1 AS component", "2 AS whitened", "3 AS size")
    check([r for r in rows if r[1] != []], whiten(other).collect())
    assert whiten(table.limit(0)).count() == whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 4, KIND)).count() == 0
    assert [len(set(c)) for c in zip(*whiten(table, 2).select("component", "n").collect())] == [2, 1]


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(k, [3.0e13 * (k % 2), float(k)]) for k in range(8)]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in found} == {None}
    assert {r["component"] for r in found} == {1}  # the other direction is below working precision


@pytest.mark.parametrize("spectrum", [
    [5.0, 3.0, 1.0, 0.5], [4.0, 4.0, 4.0, 1.0, 1.0, 0.2], [1e6, 1.0, 1.0 - 1e-13, 1e-3], [2.0, 2.0 - 1e-9, 2.0 - 2e-9, 1.0],
    [3.0, 1.0, 0.0, 0.0], [7.0], [1.0] * 5,
])
def test_counts_and_pairs(spectrum):
    n = len(spectrum)
    turn = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))[0]
    a = (turn * spectrum) @ turn.T
    a = (a + a.T) / 2
    diagonal, off = tridiagonal(a)
    for shift in (-1.0, 0.1, 0.7, 2.5, 1e5):
        assert count_above(diagonal, off, np.array([shift]))[0] == sum(v > shift for v in spectrum)
    values, vectors = leading_pairs(a, 3)
    want = [v for v in sorted(spectrum, reverse=True) if v > 0][:3]
    assert np.allclose(values, want, rtol=1e-12, atol=1e-14 * max(spectrum))
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * max(spectrum) * n
