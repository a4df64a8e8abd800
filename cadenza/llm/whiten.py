"""Embedding whitening by the exact characteristic polynomial of the integer scatter matrix.

Spark reduces the vectors to distinct integer vectors and sums their products exactly. The
scatter matrix ``n * sum(x x') - S S'`` is ``n * n`` times the covariance, without rounding.
Its characteristic polynomial comes from modular Hessenberg reductions, one prime a row,
joined by Chinese remaindering. All its roots are real, so Descartes' rule counts the roots
above any point exactly; bisection isolates the largest ones to some 30 digits. Each
component is the null space of the shifted matrix, by inverse iteration in long decimals.
What the driver holds depends on the number of dimensions, never on the number of vectors.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import stored

#: Scaled entries beyond this count as not finite: their products would not fit a decimal sum.
LIMIT = 2.0**50
#: Roots are isolated to this many bits, vectors worked out with this many digits.
ROOT_BITS, DIGITS = 96, 110
#: Rounds of inverse iteration; each gains the digits by which a root is nearer than the next one.
ROUNDS = 3


def whiten(
    table: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    components: int = 16,
    scale: int = 64,
) -> DataFrame:
    """For each vector and component: id, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error``.

    An entry ``c`` is the integer ``floor(scale * c)``; a constant added to all of them would
    change nothing. The components are fitted on the distinct integer vectors, so copies count
    once there, but every row gets its result. Dropped are rows whose vector is null, empty,
    holds nulls, entries that are not finite or beyond 2**50 when scaled, or has another
    length than most vectors (ties: the longer). Components without variance are left out:
    one distinct vector gives no rows, and a rank below ``components`` fewer of them. Of
    equal eigenvalues any orthonormal basis is returned. ``deviation`` is exact, null beyond
    64 bits. Null and repeated ids are kept as they are, further columns are not read, and an
    empty table gives an empty table.
    """
    spark = table.sparkSession
    vec = F.col(vec_col)
    scaled = lambda c: c.cast("double") * scale
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(scaled(c)) >= LIMIT)
    sound = vec.isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, odd)
    rows = table.filter(sound).select(F.col(id_col).alias("__id"), F.transform(vec, lambda c: F.floor(scaled(c))).alias("__x"))
    field = T.StructField(id_col, table.schema[id_col].dataType)
    schema = T.StructType([field, *(T.StructField(c, k) for c, k in _COLUMNS)])
    sizes = rows.groupBy(F.size("__x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    dims = sizes["size"]
    rows = rows.filter(F.size("__x") == dims)
    fit = stored(rows.select("__x").distinct(), "whiten-fit")
    n, sums, scatter = scatter_matrix(fit, dims)
    found = principal(spark, scatter, components)
    if not found:
        return spark.createDataFrame([], schema)
    trace = sum(scatter[i][i] for i in range(dims))
    axes = np.array([v for _, v in found])
    spread = np.array([math.sqrt(float(e / n / n)) for e, _ in found])
    explained = [float(e / trace) for e, _ in found]
    project = _projection(n, sums, axes / spread[:, None])
    error = _identity_error(fit, project, n, len(found))
    return rows.mapInArrow(_results(project, n, sums, explained, error, id_col), schema)


_COLUMNS = [
    ("component", T.IntegerType()),
    ("n", T.LongType()),
    ("deviation", T.LongType()),
    ("whitened", T.DoubleType()),
    ("explained", T.DoubleType()),
    ("identity_error", T.DoubleType()),
]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The vectors of a batch as rows of integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _exact_products(x: np.ndarray) -> np.ndarray:
    """``x' x`` of integers without rounding, by the fastest arithmetic that is exact."""
    bound = int(np.abs(x).max(initial=0)) ** 2 * len(x)
    if bound < 2**53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = x if bound < 2**62 else x.astype(object)
    return (y.T @ y).astype(object)


def scatter_matrix(fit: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """Count, sums and ``n * sum(x x') - S S'`` of the vectors, all exact.

    Each task sends one row for each pair of dimensions, whatever it has read.
    """

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                held += len(x)
                total = total + x.sum(axis=0).astype(object)
                products = products + _exact_products(x)
        upper = np.triu_indices(dims)
        i, j = [-1] + [-1] * dims + upper[0].tolist(), [-1] + list(range(dims)) + upper[1].tolist()
        values = [held, *total.tolist(), *products[upper].tolist()]
        cells = pa.array([decimal.Decimal(int(v)) for v in values], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), cells], ["i", "j", "v"])

    parts = fit.mapInArrow(partial, "i int, j int, v decimal(38,0)")
    whole = {(r["i"], r["j"]): int(r["v"]) for r in parts.groupBy("i", "j").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()}
    n, sums = whole[-1, -1], [whole[-1, j] for j in range(dims)]
    scatter = [[n * whole[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    return n, sums, scatter


def principal(spark: SparkSession, matrix: list[list[int]], most: int) -> list[tuple[Fraction, list[float]]]:
    """The largest positive eigenvalues of a symmetric, semi-definite integer matrix with their
    unit vectors, equal eigenvalues as often as they occur."""
    common = math.gcd(*(v for row in matrix for v in row))
    if not common:
        return []
    small = [[v // common for v in row] for row in matrix]
    roots = largest_roots(characteristic_polynomial(spark, small), most)
    vectors = _null_spaces(spark, small, roots)
    values = [root for root, times in roots for _ in range(times)]
    return [(values[k] * common, vectors[k]) for k in range(min(most, len(values)))]


# --- the polynomial -----------------------------------------------------------------


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of ``det(x I - matrix)``, lowest first, of a semi-definite matrix.

    Modulo each prime the matrix is brought to Hessenberg form; the primes are rows that
    Spark spreads over the tasks. The coefficients are bounded by the mean of the roots.
    """
    dims = len(matrix)
    trace = sum(matrix[i][i] for i in range(dims))
    mean = -(-trace // dims)
    bits = max(math.comb(dims, k) * mean**k for k in range(dims + 1)).bit_length() + 2
    primes = _primes(math.isqrt(2**62 // dims), bits)

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = batch.column(0).to_pylist()
            rests = [_hessenberg_polynomial(np.array([[v % p for v in row] for row in matrix], np.int64), p) for p in picked]
            yield pa.RecordBatch.from_arrays([pa.array(picked, pa.int64()), pa.array(rests, pa.list_(pa.int64()))], ["p", "c"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    table = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    value, modulus = np.zeros(dims + 1, object), 1
    for r in sorted(table.mapInArrow(reduce, "p long, c array<bigint>").collect()):
        inverse = pow(modulus, -1, r["p"])
        value = value + modulus * ((np.array(r["c"], object) - value) * inverse % r["p"])
        modulus *= r["p"]
    return [int(v) if 2 * v < modulus else int(v - modulus) for v in value]


def _primes(top: int, bits: int) -> list[int]:
    """The largest primes below ``top`` whose product has more than ``bits`` bits."""
    small = np.ones(math.isqrt(top) + 1, bool)
    small[:2] = False
    for k in range(2, math.isqrt(len(small)) + 1):
        small[k * k :: k] = False
    factors, found, high, width = np.flatnonzero(small), [], top, 1 << 16
    while sum(p.bit_length() - 1 for p in found) <= bits:
        low = max(len(small), high - width)
        open_ = np.ones(high - low, bool)
        for f in factors:
            open_[-low % f :: f] = False
        found += (np.flatnonzero(open_)[::-1] + low).tolist()
        high = low
    enough = next(k for k in range(len(found) + 1) if sum(p.bit_length() - 1 for p in found[:k]) > bits)
    return found[:enough]


def _hessenberg_polynomial(h: np.ndarray, p: int) -> list[int]:
    """The characteristic polynomial modulo ``p``; ``len(h) * p * p`` must stay below 2**63."""
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        h[[k, pivot]] = h[[pivot, k]]
        h[:, [k, pivot]] = h[:, [pivot, k]]
        m = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - m[:, None] * h[k]) % p
        h[:, k] = (h[:, k] + h[:, k + 1 :] @ m) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        weights, chain = np.zeros(k + 1, np.int64), 1
        weights[k] = h[k, k]
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            weights[i] = int(h[i, k]) * chain % p
        polys[k + 1, 1:] = polys[k, :-1]
        polys[k + 1] = (polys[k + 1] - weights @ polys[: k + 1]) % p
    return polys[d].tolist()


# --- its roots ------------------------------------------------------------------------


def _roots_above(poly: list[int], a: int) -> int:
    """How many roots exceed ``a``: the sign changes of the shifted polynomial, exact where all roots are real."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _sign(poly: list[int], a: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * a + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], most: int) -> list[tuple[Fraction, int]]:
    """The largest positive roots with their multiplicities, falling, at least ``most`` of them
    if there are as many. All roots must be real and none negative."""
    rank = len(poly) - 1 - next(k for k, c in enumerate(poly) if c)
    wanted = min(most, rank)
    if not wanted:
        return []
    shift, degree = 0, len(poly) - 1
    while True:  # until the smallest wanted root has enough bits before the point
        scaled = [c << (shift * (degree - k)) for k, c in enumerate(poly)]
        if _roots_above(scaled, 1 << ROOT_BITS) >= wanted:
            break
        shift += ROOT_BITS // 2
    top = 1 << abs(scaled[degree - 1]).bit_length()  # above the sum of the roots
    found, work = [], [(0, top, _roots_above(scaled, 0), 0)]
    while work:
        low, high, above_low, above_high = work.pop()
        if above_low == above_high or above_high >= wanted:
            continue
        if above_low - above_high == 1:
            found.append((_bisect(scaled, low, high), 1))
        elif high - low == 1:
            found.append((high, above_low - above_high))
        else:
            middle = (low + high) // 2
            above = _roots_above(scaled, middle)
            work += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return [(Fraction(root, 1 << shift), times) for root, times in sorted(found, reverse=True)]


def _bisect(poly: list[int], low: int, high: int) -> int:
    """The only root in ``(low, high]``, rounded up. The sign right of ``low`` may need a step."""
    at_high = _sign(poly, high)
    if not at_high:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        sign = _sign(poly, middle)
        if not sign:
            return middle
        low, high = (low, middle) if sign == at_high else (middle, high)
    return high


# --- its null spaces ------------------------------------------------------------------


def _null_spaces(spark: SparkSession, matrix: list[list[int]], roots: list[tuple[Fraction, int]]) -> dict[int, list[float]]:
    """Unit vectors by component, from 0; one row of work for each distinct root."""
    work, first = [], 0
    for root, times in roots:
        work.append((first, str(root.numerator), str(root.denominator), times))
        first += times

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = [], []
            for r in batch.to_pylist():
                for k, v in enumerate(_null_space(matrix, Fraction(int(r["num"]), int(r["den"])), r["times"])):
                    ids.append(r["first"] + k)
                    vectors.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(vectors, pa.list_(pa.float64()))], ["k", "v"])

    table = spark.createDataFrame(work, "first int, num string, den string, times int").repartition(len(work))
    return {r["k"]: r["v"] for r in table.mapInArrow(solve, "k int, v array<double>").collect()}


def _null_space(matrix: list[list[int]], root: Fraction, times: int) -> list[list[float]]:
    """``times`` orthonormal vectors that the matrix stretches by ``root``."""
    d = len(matrix)
    with decimal.localcontext(prec=DIGITS):
        shift = decimal.Decimal(root.numerator) / decimal.Decimal(root.denominator)
        lu = np.array([[decimal.Decimal(v) for v in row] for row in matrix], object)
        for i in range(d):
            lu[i, i] -= shift
        size = max(abs(v) for v in lu.ravel()) or decimal.Decimal(1)
        least = size.scaleb(-(DIGITS - 20))
        order = np.arange(d)
        for k in range(d):
            pivot = k + max(range(d - k), key=lambda i: abs(lu[k + i, k]))
            lu[[k, pivot]], order[[k, pivot]] = lu[[pivot, k]], order[[pivot, k]]
            if abs(lu[k, k]) < least:
                lu[k, k] = least
            lu[k + 1 :, k] = lu[k + 1 :, k] / lu[k, k]
            lu[k + 1 :, k + 1 :] -= lu[k + 1 :, k][:, None] * lu[k, k + 1 :]
        rng = np.random.default_rng(d)
        basis = [np.array([decimal.Decimal(int(v)) for v in rng.integers(-999, 1000, d)], object) for _ in range(times)]
        for _ in range(ROUNDS):
            made: list[np.ndarray] = []
            for v in basis:
                y = v[order]
                for k in range(d):
                    y[k + 1 :] -= lu[k + 1 :, k] * y[k]
                for k in range(d - 1, -1, -1):
                    y[k] /= lu[k, k]
                    y[:k] -= lu[:k, k] * y[k]
                for _ in range(2):  # twice, as the first pass leaves what cancels
                    y = y / (y * y).sum().sqrt()
                    for u in made:
                        y = y - (u * y).sum() * u
                made.append(y / (y * y).sum().sqrt())
            basis = made
        return [[float(x) for x in v] for v in basis]


# --- rows -----------------------------------------------------------------------------


def _projection(n: int, sums: list[int], axes: np.ndarray):
    """A function from integer vectors to their whitened coordinates; centred before multiplying."""
    centre = [(s // n, s % n / n) for s in sums]
    whole, rest = np.array([c[0] for c in centre], np.int64), np.array([c[1] for c in centre])

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - whole).astype(np.float64) - rest) @ axes.T

    return project


def _identity_error(fit: DataFrame, project, n: int, k: int) -> float:
    """How far the covariance of the whitened fit list is from the identity, measured on its rows."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = project(_matrix(batch.column(0)))
                total += w.sum(axis=0)
                products += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([*total, *products.ravel()]), pa.array(range(k + k * k), pa.int32())], ["v", "at"])

    held = fit.mapInArrow(partial, "v double, at int").groupBy("at").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(k + k * k)
    for r in held:
        flat[r["at"]] = r["v"]
    mean = flat[:k] / n
    return float(np.abs(flat[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def _results(project, n: int, sums: list[int], explained: list[float], error: float, id_col: str):
    k, total = len(explained), np.array(sums, object)
    most = max(abs(s) for s in sums)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            bound = n * int(np.abs(x).max(initial=0)) + most
            if bound * bound * x.shape[1] < 2**62:
                apart = n * x - total.astype(np.int64)
                deviation = (apart * apart).sum(axis=1).tolist()
            else:
                apart = n * x.astype(object) - total
                deviation = [v if v < 2**63 else None for v in (apart * apart).sum(axis=1)]
            m = len(x)
            each = np.repeat(np.arange(m), k)
            columns = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)),
                pa.array(deviation, pa.int64()).take(pa.array(each)),
                pa.array(project(x).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [id_col, *(c for c, _ in _COLUMNS)])

    return rows
