"""Whitening against numpy and plain integers."""

from __future__ import annotations

import math
from fractions import Fraction
from itertools import islice

import numpy as np
import pytest

from starweave.llm import charpoly, whitening
from starweave.llm.queries import LLM_QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], schema)


def usable(vectors):
    return [
        (i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v])
        for i, v in enumerate(vectors)
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]


def check(rows, vectors, count=8):
    """All that the contract says of the rows, from plain integers and numpy."""
    good = usable(vectors)
    n, x = len(good), np.array([v for _, v in good], np.int64)
    total = x.sum(axis=0)
    centred = x - total / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(count, int((e > 1e-9 * max(e[0], 1e-300)).sum()))
    assert len(rows) == n * k
    by = {(r["_row"]["vec_id"], r["component"]): r for r in rows}
    z = np.array([[by[i, c + 1]["whitened"] for c in range(k)] for i, _ in good])
    for at, (i, v) in enumerate(good):
        row = by[i, 1]
        assert row["n"] == n
        assert int(row["deviation"]) == sum((n * a - int(s)) ** 2 for a, s in zip(v, total))
    for c in range(k):
        assert abs(by[good[0][0], c + 1]["explained"] / (e[c] / e.sum()) - 1) < 1e-9
        if (c == 0 or e[c - 1] - e[c] > 1e-6 * e[0]) and (c + 1 == len(e) or e[c] - e[c + 1] > 1e-6 * e[0]):
            mine, theirs = z[:, c], centred @ u[:, c] / math.sqrt(e[c])
            assert min(abs(mine - theirs).max(), abs(mine + theirs).max()) < 1e-6
    assert abs(z.T @ z / n - np.eye(k)).max() < 1e-9
    assert rows[0]["identity_error"] < 1e-9


def random_vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    return (rng.normal(0, 0.2, (n, d)) * rng.uniform(0.2, 2, d)).astype(np.float32).tolist()


@pytest.mark.parametrize("n, d", [(200, 12), (50, 3), (9, 20)])
def test_components_and_exact_deviations(spark, n, d):
    vectors = random_vectors(n, n, d)
    vectors[3] = None
    vectors[4] = [*vectors[4][:-1], None]
    vectors[5] = [*vectors[5][:-1], math.nan]
    vectors[6] = [-math.inf, *vectors[6][1:]]
    df = table(spark, vectors).repartition(5)
    check(whitening.whitened_components(df).collect(), vectors)


def test_rank_and_equal_eigenvalues(spark):
    """Axes with equal variance, and a dimension that is the sum of two others."""
    vectors = [[s * (i == j) / 4.0 for j in range(4)] for i in range(4) for s in (-1, 1)]
    check(whitening.whitened_components(table(spark, vectors)).collect(), vectors)
    dependent = [[a / 64, b / 64, (a + b) / 64] for a in range(-3, 4) for b in range(5)]
    check(whitening.whitened_components(table(spark, dependent)).collect(), dependent)


def test_without_variance_or_rows(spark):
    assert whitening.whitened_components(table(spark, [[1.0, 2.0]] * 5)).collect() == []
    assert whitening.whitened_components(table(spark, [])).collect() == []
    assert whitening.whitened_components(table(spark, [None, [], [None], [math.nan]])).collect() == []


def test_repeats_other_lengths_and_clashing_columns(spark):
    vectors = random_vectors(2, 40, 5)
    vectors += vectors[:10]
    odd = table(spark, [*vectors, [1.0], [], [1.0] * 6])
    check(whitening.whitened_components(odd).collect(), vectors)
    rows = [(i, v, 1, "w") for i, v in enumerate(vectors)]
    clash = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, whitened string")
    check(whitening.whitened_components(clash).collect(), vectors)


def test_large_entries_stay_exact(spark):
    """Entries of 2^40: products and sums leave 64 bits."""
    rng = np.random.default_rng(3)
    vectors = [[float(c) * 2.0**20 for c in row] for row in rng.integers(-(2**18), 2**18, (30, 4))]
    x = np.array([[int(1024 * c) + 100_000 for c in v] for v in vectors], object)
    df = table(spark, vectors, "vec_id long, embedding array<double>")
    n, total = whitening.sums(df, "embedding")
    assert (n, list(total)) == (30, x.sum(axis=0).tolist())
    s = x.sum(axis=0)
    assert whitening.scatter(df, "embedding", n, total) == (30 * x.T @ x - np.outer(s, s)).tolist()


def test_characteristic_polynomial_is_exact():
    """Against the polynomial by traces (Faddeev-LeVerrier) in whole numbers."""
    rng = np.random.default_rng(5)
    for d in (1, 2, 3, 7):
        a = rng.integers(-50, 50, (d, d + 2)).astype(object)
        a[:, 0] = 0
        m = a @ a.T
        c, power = [1], np.zeros((d, d), object)
        for k in range(1, d + 1):
            power = m @ power + c[-1] * m if k > 1 else m.copy()
            c.append(-Fraction(int(np.trace(power)), k))
            assert c[-1].denominator == 1
        matrix = [[int(x) for x in row] for row in m]
        moduli = list(islice(charpoly.primes(), charpoly.coefficient_bits(matrix) // 30 + 1))
        found = charpoly.combine(charpoly.polynomials(matrix, moduli).tolist(), moduli)
        assert found == [int(x) for x in reversed(c)]


def test_roots_are_isolated_even_if_close_or_repeated():
    whole = [1, 2, 2, 2, 3 * 10**30, 3 * 10**30 + 1]
    c = [1]
    for r in whole:
        c = [a - r * b for a, b in zip([0, *c], [*c, 0])]
    roots = charpoly.Roots([0, 0, *c])
    found = [(round(Fraction(a, 1 << s)), n) for a, s, n in roots.largest(6)]
    assert roots.rank == 6
    assert found == [(3 * 10**30 + 1, 1), (3 * 10**30, 1), (2, 3), (1, 1)]


def test_query_returns_what_numpy_gives(spark):
    folder = "/root/testdata/sf0.01"
    rows = LLM_QUERIES["op13_whitening"](spark, folder).collect()
    vectors = [r["embedding"] for r in spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()]
    n, x = len(vectors), np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    assert len(rows) == 8 * n and {r["n"] for r in rows} == {n}
    away = n * x - x.sum(axis=0)
    assert {r["vec_id"]: r["deviation"] for r in rows} == dict(enumerate((away * away).sum(axis=1).tolist()))
    assert 0 <= max(r["identity_error"] for r in rows) < 1e-9
