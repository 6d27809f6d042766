"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries become integers, so the scatter matrix n * sum(x x') - S S' of the different vectors is exact: tasks add up
integer products, and only sums per pair of dimensions go on. Its characteristic polynomial is found modulo many primes
(Hessenberg form, then a recurrence; primes are dealt out to tasks) and put together by Chinese remaindering. All of its
roots are real, so the sign changes of the polynomial shifted to a point tell exactly how many roots lie above it;
bisection separates the largest ones and refines them to ``ROOT_BITS``. Inverse iteration in ``DIGITS`` digits, a task
for each eigenvalue, gives the components.

The driver holds numbers per pair of dimensions, never rows. Time grows with the fourth power of the dimension.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import stored

#: What an entry c becomes: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Scaled entries beyond this size are held at it.
LIMIT = float(1 << 62)
#: Relative width to which roots are refined, in bits; closer ones are one root of their joint multiplicity.
ROOT_BITS = 160
#: Decimal digits of the inverse iteration: those of the roots, of the matrix, and some to spare.
DIGITS = 110
LIMB_BITS = 60

_OUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


# Integer sums


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y of an integer matrix, exactly; as floats, integers or Python's integers, whichever can hold it."""
    top = max(int(y.max(initial=0)), -int(y.min(initial=0)))
    bound = top * top * max(len(y), 1)
    if bound < 1 << 53:
        f = y.astype(np.float64)
        return np.rint(f.T @ f).astype(np.int64)
    if bound < 1 << 63:
        return y.T @ y
    return y.astype(object).T @ y.astype(object)


def matrix_of(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    if not len(column):
        return np.empty((0, 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def limbs(i: int, j: int, value: int) -> Iterator[tuple[int, int, int, int]]:
    """A sum as rows (i, j, limb, part) of ``LIMB_BITS`` bits each, so that they can be added up in SQL."""
    sign, rest, k = (1 if value >= 0 else -1), abs(value), 0
    while rest:
        yield i, j, k, sign * (rest & ((1 << LIMB_BITS) - 1))
        rest, k = rest >> LIMB_BITS, k + 1


def scatter_sums(fit: DataFrame, dims: int) -> tuple[list[int], list[list[int]]]:
    """Sums of y and of y y' over the rows of ``fit`` (x), where y = x - SHIFT."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            if batch.num_rows:
                y = matrix_of(batch.column("x")) - SHIFT
                total += np.array([sum(c) for c in y.T.tolist()], object)
                products += exact_products(y)
        rows = [r for i in range(dims) for r in limbs(-1, i, int(total[i]))]
        rows += [r for i in range(dims) for j in range(i, dims) for r in limbs(i, j, int(products[i, j]))]
        columns = list(zip(*rows)) or [(), (), (), ()]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["i", "j", "limb", "part"])

    parts = fit.select("x").mapInArrow(add, "i int, j int, limb int, part long")
    sums, products = [0] * dims, [[0] * dims for _ in range(dims)]
    for r in parts.groupBy("i", "j", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect():
        value = int(r.part) << (LIMB_BITS * r.limb)
        if r.i < 0:
            sums[r.j] += value
        else:
            products[r.i][r.j] += value
            if r.i != r.j:
                products[r.j][r.i] += value
    return sums, products


# The characteristic polynomial


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 3,215,031,751."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes below 2^31, the largest first, whose product exceeds ``bound``."""
    found, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(p):
            found.append(p)
            product *= p
        p -= 2
    return found


def characteristic_mod(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(x I - matrix) modulo a prime, the highest power first."""
    a = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factor = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - factor[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factor % p).sum(1)) % p
    # Polynomials of the leading blocks of the Hessenberg form; rows hold the lowest power first.
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        up = np.zeros(k, np.int64)
        product = 1
        for i in range(k - 1, -1, -1):
            up[i] = int(a[i, k - 1]) * product % p
            if i:
                product = product * int(a[i, i - 1]) % p
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - (polys[:k] * up[:, None] % p).sum(0)) % p
    return polys[d, ::-1].tolist()


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x I - matrix) of a positive semidefinite integer matrix, the highest power first."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # The k-th symmetric function of the roots is largest where all are equal.
    bound = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    primes = primes_for(2 * bound)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [characteristic_mod(matrix, p) for p in batch.column("p").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    tasks = min(len(primes), spark.sparkContext.defaultParallelism * 2)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks, "p").mapInArrow(work, "p long, c array<long>").collect()
    values, modulus = [0] * (d + 1), 1
    for r in rows:
        inverse = pow(modulus, -1, r.p)
        values = [v + modulus * ((c - v) * inverse % r.p) for v, c in zip(values, r.c)]
        modulus *= r.p
    return [v if 2 * v < modulus else v - modulus for v in values]


# Its largest roots


def roots_above(poly: list[int], point: int, bits: int) -> int:
    """How many roots of a real-rooted polynomial exceed point / 2^bits: the sign changes after a shift to there."""
    c = [v << (bits * k) for k, v in enumerate(poly)]
    n = len(c) - 1
    for k in range(n):
        for i in range(1, n + 1 - k):
            c[i] += point * c[i - 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(poly: list[int], point: int, bits: int) -> int:
    value = 0
    for k, v in enumerate(poly):
        value = value * point + (v << (bits * k))
    return (value > 0) - (value < 0)


def _halved(low: int, high: int, bits: int) -> tuple[int, int, int, int]:
    if (high - low) % 2:
        low, high, bits = 2 * low, 2 * high, bits + 1
    return low, (low + high) // 2, high, bits


def largest_roots(poly: list[int], count: int, top: int) -> list[tuple[int, int, int]]:
    """(numerator, bits, multiplicity) of the largest positive roots, falling, until ``count`` of them are there.

    ``poly`` has only positive roots, all below ``top``. A root is numerator / 2^bits.
    """
    found: list[tuple[int, int, int]] = []
    todo = [(0, 1 << top.bit_length(), 0, len(poly) - 1, 0)]  # low, high, bits, roots above low, roots above high
    while todo and sum(m for _, _, m in found) < count:
        low, high, bits, above_low, above_high = todo.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if low and high - low <= low >> ROOT_BITS:
            found.append((low + high, bits + 1, inside))
            continue
        if inside == 1 and low:
            lows = sign_at(poly, low, bits)
            while lows and high - low > low >> ROOT_BITS:
                low, middle, high, bits = _halved(low, high, bits)
                if sign_at(poly, middle, bits) == lows:
                    low = middle
                else:
                    high = middle
            if lows:
                found.append((low + high, bits + 1, 1))
                continue
        low, middle, high, bits = _halved(low, high, bits)
        above = roots_above(poly, middle, bits)
        todo.append((low, middle, bits, above_low, above))
        todo.append((middle, high, bits, above, above_high))
    return found


# Components


def eigenvectors(matrix: list[list[int]], numerator: int, bits: int, multiplicity: int) -> list[list[float]]:
    """Orthonormal vectors of the null space of matrix - root, by inverse iteration."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        context.Emax, context.Emin = 10**9, -(10**9)
        root = Decimal(numerator) / (Decimal(2) ** bits)
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        for i in range(d):
            a[i, i] -= root
        tiny = abs(root) * Decimal(10) ** (-DIGITS)
        order = list(range(d))
        for k in range(d):
            pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
            if pivot != k:
                a[[k, pivot]] = a[[pivot, k]]
                order[k], order[pivot] = order[pivot], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.outer(a[k + 1 :, k], a[k, k + 1 :])

        def solve(b):
            x = b[order].copy()
            for i in range(1, d):
                x[i] -= a[i, :i] @ x[:i]
            for i in range(d - 1, -1, -1):
                x[i] = (x[i] - (a[i, i + 1 :] @ x[i + 1 :] if i + 1 < d else 0)) / a[i, i]
            return x

        starts = np.random.default_rng(d).integers(-99, 100, (multiplicity, d))
        found: list[np.ndarray] = []
        for start in starts.tolist():
            v = np.array([Decimal(2 * s + 1) for s in start], object)
            for _ in range(3):
                v = solve(v)
                for _ in range(2):
                    for u in found:
                        v = v - u * (u @ v)
                    v = v / (v @ v).sqrt()
            found.append(v)
        out = [np.array([float(e) for e in v]) for v in found]
    return [(v if v[np.abs(v).argmax()] > 0 else -v).tolist() for v in out]


def components(spark: SparkSession, matrix: list[list[int]], count: int = COMPONENTS) -> list[tuple[Decimal, list[float]]]:
    """(eigenvalue, unit vector) of a positive semidefinite integer matrix, falling, positive eigenvalues only."""
    poly = characteristic(spark, matrix)
    while poly[-1] == 0:
        poly = poly[:-1]  # roots at zero
    wanted = min(count, len(poly) - 1)
    if not wanted:
        return []
    roots = largest_roots(poly, wanted, sum(matrix[i][i] for i in range(len(matrix))) + 1)
    d = len(matrix)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k in batch.column("k").to_pylist():
                for v in eigenvectors(matrix, *roots[k]):
                    found.append((k, v))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.int32()), pa.array([v for _, v in found], pa.list_(pa.float64()))], names=["k", "v"]
            )

    todo = spark.createDataFrame([(k,) for k in range(len(roots))], "k int").repartition(len(roots), "k")
    rows = sorted(todo.mapInArrow(work, "k int, v array<double>").collect(), key=lambda r: r.k)
    with localcontext() as context:
        context.prec = DIGITS
        values = [Decimal(m) / (Decimal(2) ** b) for m, b, _ in roots]
    assert all(len(r.v) == d for r in rows)
    return [(values[r.k], list(r.v)) for r in rows][:wanted]


# Rows


def fixed_points(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): whole rows' vectors as integers. Rows whose vector is null, empty or holds null or non-finite entries go."""
    v = F.col(vector_col).cast("array<double>")
    usable = F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False)) & (F.size(v) > 0)
    x = F.transform(v, lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-LIMIT)), F.lit(LIMIT))) + F.lit(SHIFT).cast("long"))
    return vectors.filter(usable).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def centred_integers(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: S is the sum of x - SHIFT over the fit list, so the shift falls out."""
    y = x - SHIFT
    top = max(int(y.max(initial=0)), -int(y.min(initial=0)))
    if n * top + max(map(abs, sums)) < 1 << 62:
        return n * y - np.array(sums, np.int64)
    return n * y.astype(object) - np.array(sums, object)


def squares(centred: np.ndarray) -> np.ndarray:
    """Sum of squares of every row, exactly."""
    top = max(int(centred.max(initial=0)), -int(centred.min(initial=0)))
    if top * top * centred.shape[1] >= 1 << 63:
        centred = centred.astype(object)
    return (centred * centred).sum(1)


def projected(centred: np.ndarray, n: int, basis: np.ndarray) -> np.ndarray:
    return (centred / n).astype(np.float64) @ basis


def identity_error(fit: DataFrame, n: int, sums: list[int], basis: np.ndarray) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity. Tasks centre before they multiply."""
    k = basis.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if not batch.num_rows:
                continue
            w = projected(centred_integers(matrix_of(batch.column("x")), n, sums), n, basis)
            m, own = len(w), w.mean(0)
            products += (w - own).T @ (w - own) + np.outer(own - mean, own - mean) * (rows * m / (rows + m))
            mean += (own - mean) * (m / (rows + m))
            rows += m
        if rows:
            i, j = np.triu_indices(k)
            columns = [i.astype(np.int32), j.astype(np.int32), products[i, j], rows * mean[i] * mean[j], rows * mean[i]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "own", "means", "first"])

    parts = fit.select("x").mapInArrow(add, "i int, j int, own double, means double, first double")
    totals = {(r.i, r.j): r for r in parts.groupBy("i", "j").agg(F.sum("own").alias("own"), F.sum("means").alias("means"), F.sum("first").alias("first")).collect()}
    worst = 0.0
    for (i, j), r in totals.items():
        covariance = (r.own + r.means - totals[i, i].first * totals[j, j].first / n) / n
        worst = max(worst, abs(covariance - (i == j)))
    return worst


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per usable vector and component.

    ``n`` counts the fit list, the different integer vectors; ``deviation`` is null where it has more than 38 digits.
    Vectors that are null, empty, or hold null or non-finite entries give no row; of all others each row counts, equal
    and null ids too. Entries beyond 2^62 / 64 are held there. Repeated vectors are in the fit list once. Only positive
    eigenvalues have components, so vectors that are all alike, and an empty table, give no row. Equal eigenvalues get
    some orthonormal basis of their space. Other columns are not read. Vectors of different lengths are an error.
    """
    spark = vectors.sparkSession
    points = stored(fixed_points(vectors, id_col, vector_col), "fixed_points")
    fit = stored(points.select("x").distinct(), "fit_list")
    n, low, high = fit.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    schema = f"vec_id {points.schema['vec_id'].dataType.simpleString()}, {_OUT}"
    if n and low != high:
        raise ValueError(f"vectors of {low} to {high} entries")
    found = []
    if n:
        sums, products = scatter_sums(fit, low)
        scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(low)] for i in range(low)]
        found = components(spark, scatter, count)
    if not found:
        return spark.createDataFrame([], schema)
    trace = sum(scatter[i][i] for i in range(low))
    with localcontext() as context:
        context.prec = DIGITS
        explained = [float(e / trace) for e, _ in found]
        deviations = [float(e.sqrt() / n) for e, _ in found]
    basis = np.array([v for _, v in found]).T / np.array(deviations)
    k = len(found)
    error = identity_error(fit, n, sums, basis)
    too_long = 10**38

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            centred = centred_integers(matrix_of(batch.column("x")), n, sums)
            deviation = squares(centred).tolist()
            whitened = projected(centred, n, basis)
            row = pa.array(np.repeat(np.arange(rows), k))
            exact = pa.array([Decimal(v) if v < too_long else None for v in deviation], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(row),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)),
                    exact.take(row),
                    pa.array(whitened.reshape(-1)),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return points.mapInArrow(project, schema)
