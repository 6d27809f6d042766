"""Whitening against a float eigensolver, exact sums in Python's integers, and matrices with known eigenvalues."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import whitening

SF = "/root/testdata/sf0.001"


def integers(vector):
    return tuple(math.floor(64 * c) + 1_000_000 for c in vector)


def fit_list(rows):
    return sorted({integers(v) for v in rows})


def check(rows, got, count=16):
    """``rows``: (id, usable vector); ``got``: the result."""
    fit = fit_list([v for _, v in rows])
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    centred = np.array([[float(Fraction(n * x[k] - sums[k], n)) for k in range(d)] for x in fit])
    covariance = centred.T @ centred / n
    e, u = np.linalg.eigh(covariance)
    e, u = e[::-1], u[:, ::-1]
    k = min(count, int((e > 1e-9 * e[0]).sum())) if len(e) and e[0] > 0 else 0
    assert len(got) == k * len(rows)
    deviation = {i: sum((n * x - s) ** 2 for x, s in zip(integers(v), sums)) for i, v in rows}
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == n and int(r.deviation) == deviation[r.vec_id]
        assert r.identity_error <= 1e-9
        assert abs(r.explained - e[r.component - 1] / np.trace(covariance)) <= 1e-9 * r.explained
    if k:
        ids = sorted(by_row)
        w = np.array([[by_row[i][c + 1].whitened for c in range(k)] for i in ids])
        vectors = dict(rows)
        z = np.array([[float(Fraction(n * x - s, n)) for x, s in zip(integers(vectors[i]), sums)] for i in ids])
        want = z @ u[:, :k] / np.sqrt(e[:k])
        for c in range(k):
            near = min(abs(w[:, c] - want[:, c]).max(), abs(w[:, c] + want[:, c]).max())
            gap = min([abs(e[c] - e[o]) for o in (c - 1, c + 1) if 0 <= o < len(e)] or [e[c]]) / e[c]
            if gap > 1e-6:
                assert near < 1e-6, (c, near)


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    check([(r.vec_id, r.embedding) for r in table.collect()], whitening.whiten(table).collect())


def test_characteristic_polynomial(spark):
    rng = random.Random(5)
    for d in (1, 2, 3, 7):
        base = [[rng.randint(-50, 50) for _ in range(d)] for _ in range(d + 1)]
        matrix = [[sum(r[i] * r[j] for r in base) for j in range(d)] for i in range(d)]

        def determinant(m):  # by minors
            return m[0][0] if len(m) == 1 else sum((-1) ** j * m[0][j] * determinant([r[:j] + r[j + 1 :] for r in m[1:]]) for j in range(len(m)))

        poly = whitening.characteristic(spark, matrix)
        assert poly[0] == 1 and len(poly) == d + 1
        for x in range(-2, d + 1):
            shifted = [[(x if i == j else 0) - matrix[i][j] for j in range(d)] for i in range(d)]
            assert sum(c * x ** (d - k) for k, c in enumerate(poly)) == determinant(shifted)


def test_equal_and_zero_eigenvalues(spark):
    """A block with eigenvalues 9, 9, 9, 4, 1 and two zeros: multiplicities come out whole, zeros are left out."""
    matrix = [[0] * 7 for _ in range(7)]
    for k, v in enumerate([9, 4, 9, 0, 1, 9, 0]):
        matrix[k][k] = v
    found = whitening.components(spark, matrix)
    assert [float(e) for e, _ in found] == pytest.approx([9, 9, 9, 4, 1], rel=1e-15)
    v = np.array([v for _, v in found])
    assert np.abs(v @ v.T - np.eye(5)).max() < 1e-15
    assert np.abs(v @ np.array(matrix) - v * np.array([9, 9, 9, 4, 1])[:, None]).max() < 1e-12


def test_close_eigenvalues(spark):
    big = 10**14
    matrix = [[big, 1, 0], [1, big, 0], [0, 0, big + 1]]  # big + 1 twice and big - 1
    found = whitening.components(spark, matrix, 3)
    assert [int(e) - big if e == int(e) else round(float(e - big), 6) for e, _ in found] == pytest.approx([1, 1, -1], abs=1e-6)
    assert np.abs(np.array(found[2][1])) == pytest.approx([0.5**0.5, 0.5**0.5, 0], abs=1e-15)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    usable = [(1, [0.5, 1.0, -2.0]), (2, [0.5, 1.0, -2.0]), (3, [0.501, 1.0, -2.0]), (4, [3.0, 0.0, 0.25]), (5, [-1.0, 2.0, 8.0]), (7, [0.0, 0.0, 0.0])]
    odd = [(10, None), (11, []), (12, [1.0, None, 2.0]), (13, [nan, 0.0, 0.0]), (14, [inf, 1.0, 1.0])]
    schema = "vec_id long, embedding array<double>"
    frame = spark.createDataFrame(usable + odd, schema).withColumn("x", F.lit("clash")).withColumn("n", F.lit(1))
    got = whitening.whiten(frame).collect()
    check(usable, got)
    assert got[0].n == 4  # 0.5 and 0.501 are one integer, the repeated vector another row of it
    doubled = whitening.whiten(frame.unionByName(frame.withColumn("vec_id", F.lit(None).cast("long")))).collect()
    assert len(doubled) == 2 * len(got) and sum(r.vec_id is None for r in doubled) == len(got)
    assert whitening.whiten(frame.limit(0)).collect() == []
    assert whitening.whiten(frame.filter("vec_id = 1")).collect() == []
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema))


def test_huge_entries_stay_exact(spark):
    rows = [(1, [1e30, 0.0]), (2, [-3e15, 5.0]), (3, [2e15, -7e14]), (4, [0.0, 1e9])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in whitening.whiten(frame).collect()}
    x = {i: [max(-(1 << 62), min(1 << 62, math.floor(64 * c))) for c in v] for i, v in rows}
    sums = [sum(v[k] for v in x.values()) for k in range(2)]
    for i, v in x.items():
        want = sum((4 * c - s) ** 2 for c, s in zip(v, sums))
        assert got[i, 1].deviation is None if want >= 10**38 else int(got[i, 1].deviation) == want
    assert got[1, 1].identity_error < 1e-9
