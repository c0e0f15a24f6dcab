"""Embedding whitening by the exact characteristic polynomial.

A vector's entries become whole numbers, 256-fold and rounded down. The scatter
of the distinct vectors, n * sum(x x') - S S' with S their sum, is then a matrix of
whole numbers, n * n times their covariance, and is summed without any rounding:

* its characteristic polynomial is computed modulo many primes (reduction to
  Hessenberg form, each prime in its own row of a Spark job) and put together by
  Chinese remainders, with enough primes for the largest coefficient there can be;
* as all roots are real, the sign changes after a shift by a are exactly the
  number of roots above a: roots are isolated by halving, simple ones are then
  narrowed by the polynomial's sign, to ``ROOT_BITS`` binary places;
* a component spans the null space of the scatter less the root: inverse iteration
  with fixed-point numbers of ``POINT_BITS`` binary places. Equal roots get
  orthogonal vectors. Each component is a row of a Spark job.

Whitened values are projections of the centred vectors on the components over the
roots of the eigenvalues. What reaches the driver depends on the dimension only.

Defined results: vectors that are null or hold a null, infinite or NaN entry are
left out; empty vectors have no components, so no rows; vectors of each length are
fitted by themselves; entries beyond the range of a long take its bound; repeated
rows and rows without an id each have their results, the fit counts equal vectors
once; fewer dimensions than components asked for give as many components; a
component without variance (e = 0: single vectors, too few for the dimension) has
null as whitened value and explains 0, and takes no part in the identity error;
a deviation beyond the range of a long is null; an empty table gives an empty
result. Other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerkit.llm.tables import read_table, ship, stored

SCALE = 256
ROOT_BITS = 128
POINT_BITS = 512
ROUNDS = 8
ROWS = 4096
LIMB = 1 << 62
WHITE = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


# Sums over the fit list


def exact_products(x: np.ndarray) -> np.ndarray:
    """x' x of whole numbers, as Python numbers where it must be."""
    top = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if top * top * len(x) < 1 << 53:
        f = x.astype(np.float64)  # every partial sum is a whole number below 2 ** 53
        return (f.T @ f).astype(np.int64).astype(object)
    if top < 1 << 31:
        step = max(1, (1 << 62) // (top * top))
        return sum((x[i:i + step].T @ x[i:i + step]).astype(object) for i in range(0, len(x), step))
    o = x.astype(object)
    return o.T @ o


def _lists(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, sums and products of a partition: (i, j) and two limbs of a number."""
    n, first, second = 0, 0, 0
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            x = _lists(whole.column(0).slice(at, ROWS))
            n, first, second = n + len(x), first + x.astype(object).sum(axis=0), second + exact_products(x)
    if n:
        d = len(first)
        rows = [(-1, -1, n), *((i, -1, first[i]) for i in range(d)), *((i, j, second[i, j]) for i in range(d) for j in range(i, d))]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
            pa.array([Decimal(int(r[2]) // LIMB) for r in rows], pa.decimal128(38, 0)),
            pa.array([Decimal(int(r[2]) % LIMB) for r in rows], pa.decimal128(38, 0)),
        ], names=["i", "j", "high", "low"])


def moments(fit: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """n, S and the scatter n * sum(x x') - S S' of the fit list, exactly."""
    parts = fit.mapInArrow(_sums, "i int, j int, high decimal(38,0), low decimal(38,0)")
    total = {(r["i"], r["j"]): int(r["high"]) * LIMB + int(r["low"])
             for r in parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    n, s = total[-1, -1], [total[i, -1] for i in range(d)]
    scatter = np.empty((d, d), dtype=object)
    for i in range(d):
        for j in range(i, d):
            scatter[i, j] = scatter[j, i] = n * total[i, j] - s[i] * s[j]
    return n, s, scatter


# Characteristic polynomial


def is_prime(n: int) -> bool:
    """Miller and Rabin's test; these bases decide all numbers below 3 * 10 ** 9."""
    if n < 9 or not n % 2:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while not odd % 2:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        if base >= n:
            continue
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_over(bound: int) -> list[int]:
    """Primes below 2 ** 31, from the top, until their product exceeds ``bound``."""
    out, product, p = [], 1, 2**31 - 1
    while product <= bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x I - matrix) modulo ``p``, the constant one first."""
    h = (matrix % p).astype(np.int64)
    n = len(h)
    for k in range(n - 2):  # similar matrix without entries below the subdiagonal
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        r = k + 1 + int(below[0])
        if r != k + 1:
            h[[r, k + 1]] = h[[k + 1, r]]
            h[:, [r, k + 1]] = h[:, [k + 1, r]]
        f = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - f[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * f % p).sum(axis=1)) % p
    poly = np.zeros((n + 1, n + 1), dtype=np.int64)
    poly[0, 0] = 1
    for k in range(1, n + 1):  # of the leading k x k part
        poly[k, 1:] = poly[k - 1, :-1]
        factor = np.zeros(k, dtype=np.int64)  # of the polynomials of smaller parts
        t = 1
        for i in range(k - 1, -1, -1):
            factor[i] = t * int(h[i, k - 1]) % p
            t = t * int(h[i, i - 1]) % p if i else 0
        poly[k] = (poly[k] - (factor[:, None] * poly[:k] % p).sum(axis=0)) % p
    return poly[n]


def characteristic(spark: SparkSession, scatter: np.ndarray) -> list[int]:
    """Coefficients of det(x I - scatter), the constant one first. The matrix has
    no negative eigenvalue, which bounds the sums of their products."""
    d, trace = len(scatter), int(sum(scatter[i, i] for i in range(len(scatter))))
    bound = max(math.comb(d, k) * (trace**k // d**k + 1) for k in range(d + 1))
    primes = primes_over(2 * bound)
    shared = spark.sparkContext.broadcast((scatter, primes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, primes = shared.value
        for b in batches:
            for k in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([polynomial_mod(matrix, primes[k]).tolist()], pa.list_(pa.int64()))], names=["k", "residues"])

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    found = spark.range(0, len(primes), 1, tasks).mapInArrow(run, "k bigint, residues array<bigint>").collect()
    product = math.prod(primes)
    total = [0] * (d + 1)
    for r in found:
        p = primes[r["k"]]
        other = product // p
        one = other * pow(other, -1, p)
        total = [t + one * c for t, c in zip(total, r["residues"])]
    return [t - product if (t := x % product) > product // 2 else t for x in total]


# Roots


def roots_above(poly: list[int], a: int, s: int) -> int:
    """How many roots exceed a / 2 ** s, with multiplicity; all roots are real."""
    n = len(poly) - 1
    c = [x << s * (n - k) for k, x in enumerate(poly)]
    for i in range(n):  # shift by a
        for k in range(n - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(poly: list[int], a: int, s: int) -> int:
    n = len(poly) - 1
    value = poly[n]
    for k in range(n - 1, -1, -1):
        value = value * a + (poly[k] << s * (n - k))
    return (value > 0) - (value < 0)


def root(poly: list[int], k: int, bits: int = ROOT_BITS) -> tuple[int, int, int, int] | None:
    """The k-th largest root (from 1) of a polynomial whose roots are real and not
    negative: (lo, hi, s, first), in (lo / 2 ** s, hi / 2 ** s], and which of the
    roots in there is the first. None if it is zero."""
    zeros = next(i for i, c in enumerate(poly) if c)
    if k > len(poly) - 1 - zeros:
        return None
    n = len(poly) - 1
    lo, hi, s = 0, max(-poly[n - 1], 1), 0  # the sum of the roots
    above_lo, above_hi = n - zeros, 0
    while hi - lo > 1 or lo < 1 << bits:
        if hi - lo <= 1:
            lo, hi, s = lo << 16, hi << 16, s + 16
        if (hi - lo) << bits <= lo:
            break
        mid = (lo + hi) // 2
        if above_lo - above_hi == 1:  # one simple root: beyond it the sign is known
            over = sign_at(poly, mid, s) in (0, (-1) ** above_hi)
        else:
            above = roots_above(poly, mid, s)
            over = above < k
            if over:
                above_hi = above
            else:
                above_lo = above
        lo, hi = (lo, mid) if over else (mid, hi)
    return lo, hi, s, above_hi + 1


# Components


def null_vectors(matrix: np.ndarray, a: int, s: int, count: int, bits: int = POINT_BITS) -> list[list[int]]:
    """``count`` orthogonal vectors, in fixed-point numbers of ``bits`` binary
    places, that the matrix less a / 2 ** s brings nearest to zero."""
    n = len(matrix)
    m = np.array([[int(x) << bits for x in row] for row in matrix], dtype=object).reshape(n, n)
    shift = a << bits >> s
    for i in range(n):
        m[i, i] -= shift
    order = np.arange(n)
    factors = np.zeros((n, n), dtype=object)
    for k in range(n):
        best = k + max(range(n - k), key=lambda r: abs(m[k + r, k]))
        if best != k:
            m[[k, best]], factors[[k, best]], order[[k, best]] = m[[best, k]], factors[[best, k]], order[[best, k]]
        if not m[k, k]:
            m[k, k] = 1
        if k + 1 < n:
            f = (m[k + 1:, k] << bits) // m[k, k]
            factors[k + 1:, k] = f
            m[k + 1:, k + 1:] -= np.multiply.outer(f, m[k, k + 1:]) >> bits

    def solve(v: np.ndarray) -> np.ndarray:
        v = v[order]
        for k in range(n - 1):
            v[k + 1:] -= factors[k + 1:, k] * v[k] >> bits
        for k in range(n - 1, -1, -1):
            v[k] = ((v[k] - ((m[k, k + 1:] * v[k + 1:]).sum() >> bits)) << bits) // m[k, k]
        return v

    def unit(v: np.ndarray) -> np.ndarray:
        return (v << bits) // max(math.isqrt(int((v * v).sum())), 1)

    start = np.random.Generator(np.random.PCG64(n))
    found: list[np.ndarray] = []
    for _ in range(count):
        v = unit(np.array([int(x) << bits for x in start.integers(1, 1 << 30, n)], dtype=object))
        for _ in range(ROUNDS):
            v = unit(solve(v))
            for _ in range(2):
                for u in found:
                    v = v - (u * (int((u * v).sum()) >> bits) >> bits)
            v = unit(v)
        found.append(v)
    return [[int(x) for x in v] for v in found]


def _component(scatter: np.ndarray, poly: list[int], k: int, n: int) -> tuple[float, float, list[float]]:
    """Eigenvalue of the covariance, its share of the trace, and the unit vector."""
    found = root(poly, k)
    if found is None:
        return 0.0, 0.0, [0.0] * len(scatter)
    lo, hi, s, first = found
    vectors = null_vectors(scatter, lo + hi, s + 1, k - first + 1)
    v = vectors[k - first]
    top = max(range(len(v)), key=lambda i: (abs(v[i]), -i))
    sign = -1 if v[top] < 0 else 1
    length = math.isqrt(sum(x * x for x in v))
    trace = int(sum(scatter[i, i] for i in range(len(scatter))))
    return (lo + hi) / (n * n << s + 1), (lo + hi) / (trace << s + 1), [sign * x / length for x in v]


def components(spark: SparkSession, scatter: np.ndarray, n: int, count: int) -> list[tuple[float, float, list[float]]]:
    """The first components: eigenvalue, share of the trace, unit vector."""
    poly = characteristic(spark, scatter)
    count = min(count, len(scatter))
    shared = spark.sparkContext.broadcast((scatter, poly))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter, poly = shared.value
        for b in batches:
            for k in b.column(0).to_pylist():
                e, share, v = _component(scatter, poly, k, n)
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([e]), pa.array([share]), pa.array([v], pa.list_(pa.float64()))], names=["k", "e", "share", "v"])

    found = spark.range(1, count + 1, 1, count).mapInArrow(run, "k bigint, e double, share double, v array<double>").collect()
    return [(r["e"], r["share"], r["v"]) for r in sorted(found, key=lambda r: r["k"])]


# Whitening


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n x - S, as Python numbers where it must be."""
    top = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if n * top + max(map(abs, s)) < 1 << 63:
        return n * x - np.array(s, dtype=np.int64)
    return n * x.astype(object) - np.array(s, dtype=object)


def squares(y: np.ndarray) -> list[int | None]:
    """Each row's sum of squares; None beyond the range of a long."""
    top = max(abs(int(y.min())), abs(int(y.max()))) if y.size else 0
    if top * top * y.shape[1] < 1 << 63:
        return (y.astype(np.int64) ** 2).sum(axis=1).tolist()
    o = y.astype(object)
    return [v if (v := int(x)) < 1 << 63 else None for x in (o * o).sum(axis=1)]


def _project(y: np.ndarray, n: int, axes: np.ndarray) -> np.ndarray:
    return (y.astype(np.float64) / n) @ axes


def usable(vector: Column) -> Column:
    value = vector.cast("array<double>")
    return vector.isNotNull() & F.coalesce(F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))


def whiten(vectors: DataFrame, keep: list[str], vector_col: str = "embedding", count: int = 4) -> DataFrame:
    """``keep`` columns, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``: a row for each usable row and component."""
    spark = vectors.sparkSession
    ship(spark)
    fine = vectors.where(usable(F.col(vector_col))).select(
        F.struct(*keep).alias("kept"), F.transform(F.col(vector_col).cast("array<double>"), lambda v: F.floor(v * SCALE)).alias("x"))
    fit = stored(fine.select("x").where(F.size("x") > 0).distinct(), "whitening-fit")
    kind = StructType([fine.schema["kept"], *StructType.fromDDL(WHITE)])
    out = []
    for d in sorted(r["d"] for r in fit.select(F.size("x").alias("d")).distinct().collect()):
        out.append(_whitened(fine.where(F.size("x") == d), fit.where(F.size("x") == d), d, count, kind))
    whole = out[0] if out else spark.createDataFrame([], kind)
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole.select("kept.*", *StructType.fromDDL(WHITE).names)


def _whitened(rows: DataFrame, fit: DataFrame, d: int, count: int, kind: StructType) -> DataFrame:
    spark = rows.sparkSession
    n, s, scatter = moments(fit, d)
    found = components(spark, scatter, n, count)
    axes = np.array([[x / math.sqrt(e) if e else 0.0 for x in v] for e, _, v in found]).T
    shared = spark.sparkContext.broadcast((axes, s))
    k = len(found)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition's sums and products of whitened values, which are centred."""
        axes, s = shared.value
        total, cross = np.zeros(k), np.zeros((k, k))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                w = _project(centred(_lists(whole.column(0).slice(at, ROWS)), n, s), n, axes)
                total += w.sum(axis=0)
                cross += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k + k), pa.int32()), pa.array(np.concatenate([total, cross.ravel()]))], names=["i", "value"])

    sums = {r["i"]: r["value"] for r in fit.mapInArrow(spread, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()}
    mean = np.array([sums[i] for i in range(k)]) / n
    cov = np.array([sums[k + i] for i in range(k * k)]).reshape(k, k) / n - np.outer(mean, mean)
    full = [i for i, (e, _, _) in enumerate(found) if e]
    error = float(np.abs(cov[np.ix_(full, full)] - np.eye(len(full))).max()) if full else 0.0
    explained = [share for _, share, _ in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, s = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                y = centred(_lists(b.column(1)), n, s)
                w = _project(y, n, axes)
                row = np.repeat(np.arange(b.num_rows), k)
                one = np.tile(np.arange(k), b.num_rows)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(row)),
                    pa.array(one + 1, pa.int32()),
                    pa.array(np.full(len(row), n), pa.int64()),
                    pa.array(squares(y), pa.int64()).take(pa.array(row)),
                    pa.array(w.ravel(), mask=~np.isin(one, full)),
                    pa.array(np.array(explained)[one]),
                    pa.array(np.full(len(row), error)),
                ], names=kind.names)

    return rows.mapInArrow(run, kind)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"), ["vec_id"])
