"""Embedding whitening by the exact characteristic polynomial of an integer scatter matrix.

Each entry c becomes the integer floor(64 c) + 1000000. The covariance is taken over the distinct integer
vectors. With n of them and sums S, the matrix ``n * sum(x x') - S S'`` is n^2 times the covariance and
holds integers only, so everything up to the eigenvalues is exact:

1. Spark sums the products over the distinct vectors (floating-point products of small limbs, whose
   sums stay below 2^53, added as DECIMAL), and only the d x d sums reach the driver.
2. The characteristic polynomial is found modulo as many 31-bit primes as its coefficients need (a
   Spark row each: reduction to Hessenberg form, then the recurrence for the polynomial), and put together by Chinese remaindering.
3. All roots are real, so the sign changes of the polynomial shifted to a (Descartes) count the roots above
   a exactly. Halving intervals isolates the largest roots; sign changes of exact values narrow each one to ``PRECISION`` bits.
4. The component of a root spans the null space of (matrix - root); inverse iteration in 130-digit decimals finds
   it (a Spark row for each root). A root of multiplicity m gets m orthogonal components.

Memory is bounded by the matrix. The primes' number grows with d and each costs d^3, so this is meant for
up to a few hundred dimensions.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries, are dropped. Vectors
of each length are fitted for themselves. Components with eigenvalue zero can't be scaled and are
left out, so a fit of rank r gives min(16, r) rows for each vector, and a single distinct vector none. 64 c is held within
+-2^62. A deviation beyond the range of long is null in ``deviation`` and given in ``deviation_exact``. A component's sign makes its largest entry positive. Repeated
rows and null vec_ids are kept, extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import column, prepare, stage

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Largest absolute value of floor(64 c).
MOST = 1 << 62
#: Bits to which roots are known, against the trace; roots closer than that count as equal.
PRECISION = 200
#: Digits of the null spaces' arithmetic.
DIGITS = 130
#: Integers are multiplied in limbs of so many bits, some rows at a time: sums then are exact in doubles.
LIMB, ROWS = 20, 1 << 12


# ---------------------------------------------------------------- integers of the vectors


def whole(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows of the batch, their integers floor(64 c)) for each length of the valid vectors."""
    lists = column(batch, "embedding")
    lists = lists.filter(pc.is_valid(lists)) if lists.null_count else lists
    at = np.flatnonzero(column(batch, "embedding").is_valid().to_numpy(zero_copy_only=False))
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    c = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    with np.errstate(over="ignore"):
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(c))])
        q = np.floor(c * SCALE)
    for d in np.unique(size[size > 0]):
        rows = np.flatnonzero((size == d) & (bad[start + size] == bad[start]))
        if len(rows):
            q_d = q[start[rows][:, None] + np.arange(d)]
            yield int(d), at[rows], np.clip(q_d, -float(MOST), float(MOST)).astype(np.int64)


def packed(q: np.ndarray) -> Iterator[pa.Array]:
    """The rows as bytes in the narrowest integers that hold each, so that equal vectors have equal bytes."""
    most = np.maximum(q.max(1), ~q.min(1))
    width = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    for w in np.unique(width):
        held = np.ascontiguousarray(q[width == w].astype(f"<i{w}"))
        offsets = np.arange(len(held) + 1, dtype=np.int32) * held[0].nbytes
        yield pa.Array.from_buffers(pa.binary(), len(held), [None, pa.py_buffer(offsets), pa.py_buffer(held)])


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The integers of rows (dim, code), by length and width, at most ``ROWS`` rows at a time."""
    dim, code = column(batch, "dim").to_numpy(), column(batch, "code")
    width = pc.binary_length(code).to_numpy(zero_copy_only=False) // np.maximum(dim, 1)
    for d, w in sorted(set(zip(dim.tolist(), width.tolist(), strict=True))):
        rows = np.flatnonzero((dim == d) & (width == w))
        for k in range(0, len(rows), ROWS):
            held = code.take(pa.array(rows[k : k + ROWS]))
            start = np.frombuffer(held.buffers()[1], np.int32, 1, held.offset * 4)[0]
            yield d, np.frombuffer(held.buffers()[2], f"<i{w}", len(held) * d, start).reshape(-1, d).astype(np.int64)


def fit_list(vectors: DataFrame) -> DataFrame:
    """(dim, code): every distinct integer vector once."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, _, q in whole(b):
                for code in packed(q):
                    yield pa.RecordBatch.from_pydict({"dim": pa.array(np.full(len(code), d, np.int32)), "code": code})

    return vectors.select("embedding").mapInArrow(codes, "dim int, code binary").distinct()


# ---------------------------------------------------------------- exact sums


def limbs(q: np.ndarray) -> list[np.ndarray]:
    """q as a sum of limbs times powers of 2^LIMB, the last of which has the sign."""
    out = []
    while q.size and (q.max() >= 1 << LIMB or q.min() < -(1 << LIMB)):
        out.append((q & ((1 << LIMB) - 1)).astype(np.float64))
        q = q >> LIMB
    return [*out, q.astype(np.float64)]


def sums(fit: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """For each length d: the number of vectors, the sums of their integers, and those of their products, as Python integers."""
    kind = "dim int, power int, i int, j int, value decimal(38,0)"

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}

        def add(d: int, power: int, value: np.ndarray) -> None:
            """Sums (d + 1) x (d + 1): products, and in the last row and column plain sums and the count."""
            key = d, power
            total[key] = value.astype(np.int64).astype(object) + total.get(key, 0)

        for b in batches:
            for d, q in unpacked(b):
                parts = limbs(q)
                for k, x in enumerate(parts):
                    for m, y in enumerate(parts):
                        ends = (np.ones((len(q), 1)) if at == 0 else np.zeros((len(q), 1)) for at in (k, m))
                        left, right = (np.hstack([z, e]) for z, e in zip((x, y), ends, strict=True))
                        add(d, k + m, left.T @ right)
        for (d, power), value in total.items():
            i, j = np.nonzero(np.triu(value != 0))
            out = pa.array([Decimal(int(v)) for v in value[i, j]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), x, np.int32)) for x in (d, power)] + [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), out], names=["dim", "power", "i", "j", "value"])

    found: dict[int, np.ndarray] = {}
    for r in fit.mapInArrow(products, kind).groupBy("dim", "power", "i", "j").agg(F.sum("value").alias("value")).collect():
        m = found.setdefault(r["dim"], np.zeros((r["dim"] + 1,) * 2, object))
        m[r["i"], r["j"]] += int(r["value"]) << LIMB * r["power"]
    out = {}
    for d, m in found.items():
        m = m + np.triu(m, 1).T
        out[d] = m[d, d], m[:d, d], m[:d, :d]
    return out


# ---------------------------------------------------------------- characteristic polynomial


def is_prime(n: int) -> bool:
    """Miller and Rabin's test, which with these bases is right below 3 * 10^9."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2^31 whose product exceeds ``bound``."""
    out, product, n = [], 1, 1 << 31
    while product <= bound:
        n -= 1
        if is_prime(n):
            out.append(n)
            product *= n
    return out


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (from x^0) of det(x - a) modulo ``p`` < 2^31, by reduction to Hessenberg form."""
    a, d = a.copy(), len(a)
    for k in range(d - 2):
        rows = np.flatnonzero(a[k + 1 :, k])
        if not len(rows):
            continue
        r = k + 1 + rows[0]
        a[[k + 1, r]] = a[[r, k + 1]]
        a[:, [k + 1, r]] = a[:, [r, k + 1]]
        u = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :, k:] = (a[k + 2 :, k:] - u[:, None] * a[k + 1, k:] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * u % p).sum(1)) % p
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for m in range(1, d + 1):
        weight, below = np.zeros(m, np.int64), 1
        weight[m - 1] = a[m - 1, m - 1]
        for i in range(m - 1, 0, -1):
            below = below * int(a[i, i - 1]) % p
            weight[i - 1] = below * int(a[i - 1, m - 1]) % p
        minors[m, 1:] = minors[m - 1, :-1]
        minors[m] = (minors[m] - (weight[:, None] * minors[:m] % p).sum(0)) % p
    return minors[d]


def remaindered(residues: list[tuple[int, list[int]]]) -> list[int]:
    """The numbers below the product of the primes with these residues."""
    product = math.prod(p for p, _ in residues)
    total = [0] * len(residues[0][1])
    for p, rest in residues:
        others = product // p
        unit = others * pow(others % p, -1, p)
        total = [t + r * unit for t, r in zip(total, rest, strict=True)]
    return [t % product for t in total]


def polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients (from x^0) of det(x - matrix) for a positive semidefinite matrix of Python integers."""
    d, trace = len(matrix), int(np.trace(matrix))
    # coefficients are, but for signs, symmetric sums of d roots that are not negative and add up to the trace
    bound = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    primes = primes_beyond(bound)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = column(b, "p").to_pylist()
            # signs alternate, so that all residues belong to numbers that are not negative
            sign = np.array([(-1) ** (d - k) for k in range(d + 1)])
            rest = [(polynomial_mod((matrix % x).astype(np.int64), x) * sign % x).tolist() for x in p]
            yield pa.RecordBatch.from_pydict({"p": pa.array(p, pa.int64()), "rest": pa.array(rest, pa.list_(pa.int64()))})

    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 32)).mapInArrow(residues, "p long, rest array<long>").collect()
    return [c * (-1) ** (d - k) for k, c in enumerate(remaindered([(r["p"], r["rest"]) for r in rows]))]


# ---------------------------------------------------------------- roots


class Roots:
    """Counts and signs of an integer polynomial with real roots at dyadic points m * 2^s."""

    def __init__(self, coefficients: list[int]) -> None:
        self.c = coefficients

    def scaled(self, m: int, s: int) -> tuple[list[int], int]:
        """An integer polynomial and point that stand for this polynomial at m * 2^s."""
        if s >= 0:
            return self.c, m << s
        d = len(self.c) - 1
        return [c << -s * (d - k) for k, c in enumerate(self.c)], m

    def above(self, m: int, s: int) -> int:
        """Roots above the point, with multiplicity: sign changes of the polynomial shifted to it."""
        c, a = self.scaled(m, s)
        c = list(c)
        for k in range(len(c) - 1):
            for j in range(len(c) - 2, k - 1, -1):
                c[j] += a * c[j + 1]
        signs = [x > 0 for x in c if x]
        return sum(x != y for x, y in zip(signs, signs[1:], strict=False))

    def sign(self, m: int, s: int) -> int:
        c, a = self.scaled(m, s)
        value = 0
        for x in reversed(c):
            value = value * a + x
        return (value > 0) - (value < 0)


class Root(NamedTuple):
    value: Fraction
    multiplicity: int


def largest_roots(coefficients: list[int], most: int) -> list[Root]:
    """The largest roots above 0, in falling order, until they are ``most`` with multiplicity; the coefficients are those of a
    polynomial whose roots are real and not negative."""
    zeros = next(k for k, c in enumerate(coefficients) if c)
    poly = Roots(coefficients[zeros:])
    rank = len(poly.c) - 1
    if not rank:
        return []
    trace = -poly.c[-2]
    top = trace.bit_length()
    finest = top - PRECISION
    # intervals (m * 2^s, (m + 1) * 2^s] and the roots above their lower and upper ends; the topmost is the last
    todo, out, found = [(0, top, rank, 0)], [], 0
    while todo and found < most:
        m, s, low, high = todo.pop()
        n = low - high
        if not n:
            continue
        if n > 1 and (s > finest or m < 1 << 100):
            mid = poly.above(2 * m + 1, s - 1)
            todo += [(2 * m, s - 1, low, mid), (2 * m + 1, s - 1, mid, high)]
            continue
        if n == 1:
            above = poly.sign(m + 1, s)
            while above and (s > finest or m < 1 << 100):
                middle = poly.sign(2 * m + 1, s - 1)
                m, s = (2 * m + (middle != above and middle != 0), s - 1)
                above = middle if middle == 0 else above
            value = Fraction(m + 1 if above == 0 else 2 * m + 1, 1 if above == 0 else 2) * Fraction(2) ** s
        else:
            value = Fraction(2 * m + 1, 2) * Fraction(2) ** s
        out.append(Root(value, n))
        found += n
    return out


# ---------------------------------------------------------------- components


def null_space(matrix: np.ndarray, root: Fraction, size: int) -> np.ndarray:
    """``size`` orthonormal vectors (rows) that span the null space of ``matrix - root``, by inverse iteration."""
    d = len(matrix)
    with localcontext() as ctx:
        ctx.prec = DIGITS
        decimal = np.frompyfunc(Decimal, 1, 1)
        at = Decimal(root.numerator) / Decimal(root.denominator)
        a = decimal(matrix)
        a[np.diag_indices(d)] -= at
        least = max(abs(a).max(), Decimal(1)) * Decimal(10) ** (20 - DIGITS)
        order = np.arange(d)
        for k in range(d):
            r = k + int(np.argmax(abs(a[k:, k])))
            a[[k, r]], order[[k, r]] = a[[r, k]], order[[r, k]]
            if abs(a[k, k]) < least:
                a[k, k] = least
            a[k + 1 :, k] /= a[k, k]
            a[k + 1 :, k + 1 :] -= np.multiply.outer(a[k + 1 :, k], a[k, k + 1 :])
        out: list[np.ndarray] = []
        # bits of a fixed sequence: the starting vectors have a part in every direction
        word = 0x9E3779B9
        for _ in range(size):
            v = np.zeros(d, object)
            for i in range(d):
                word = (word * 1664525 + 1013904223) % (1 << 32)
                v[i] = Decimal((word >> 8) - (1 << 23))
            for _ in range(3):
                v = v[order]
                for k in range(d):
                    v[k + 1 :] -= a[k + 1 :, k] * v[k]
                for k in range(d - 1, -1, -1):
                    v[k] = (v[k] - (a[k, k + 1 :] * v[k + 1 :]).sum()) / a[k, k]
                for _ in range(2):
                    for u in out:
                        v = v - u * (u * v).sum()
                    v = v / (v * v).sum().sqrt()
            out.append(v)
        return np.array([x.astype(np.float64) for x in out])


class Fit(NamedTuple):
    """Vectors (n), sums of their integers, component rows, square roots of eigenvalues, shares of the trace."""

    n: int
    total: list[int]
    components: np.ndarray
    spread: np.ndarray
    explained: np.ndarray


def components(spark: SparkSession, n: int, total: np.ndarray, products: np.ndarray, most: int = COMPONENTS) -> Fit:
    """The whitening of vectors with these sums."""
    matrix = n * products - np.multiply.outer(total, total)
    trace = int(np.trace(matrix))
    d = len(matrix)
    if not trace:
        return Fit(n, total.tolist(), np.zeros((0, d)), np.zeros(0), np.zeros(0))
    roots = largest_roots(polynomial(spark, matrix), most)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in column(b, "at").to_pylist():
                rows = null_space(matrix, roots[at].value, roots[at].multiplicity)
                yield pa.RecordBatch.from_pydict({"at": pa.array([at] * len(rows), pa.int32()), "place": pa.array(range(len(rows)), pa.int32()), "v": pa.array(rows.tolist(), pa.list_(pa.float64()))})

    rows = spark.createDataFrame([(k,) for k in range(len(roots))], "at int").repartition(len(roots), "at").mapInArrow(spans, "at int, place int, v array<double>").collect()
    rows = sorted(rows, key=lambda r: (r["at"], r["place"]))[:most]
    v = np.array([r["v"] for r in rows])
    v *= np.sign(v[np.arange(len(v)), np.argmax(np.abs(v), axis=1)])[:, None]
    values = [roots[r["at"]].value for r in rows]
    return Fit(n, total.tolist(), v, np.array([math.sqrt(x / n**2) for x in values]), np.array([float(x / trace) for x in values]))


# ---------------------------------------------------------------- the operator


def centred(q: np.ndarray, fit: Fit) -> np.ndarray:
    """n q - S, in 64-bit integers if they hold it and else in Python's."""
    n, total = fit.n, fit.total
    most = max(int(q.max()), -int(q.min())) * n + max(map(abs, total))
    if most < 1 << 62:
        return n * q - np.array(total, np.int64)
    return n * q.astype(object) - np.array(total, object)


def projected(c: np.ndarray, fit: Fit) -> np.ndarray:
    x = (c / fit.n).astype(np.float64)
    # a sum along each row, and no matrix product, so that a row's result doesn't depend on its batch
    return np.stack([(x * v).sum(1) for v in fit.components], axis=1) / fit.spread if len(fit.spread) else np.zeros((len(x), 0))


def deviations(c: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Sums of squares of rows: as long (null beyond its range) and as DECIMAL(38, 0)."""
    most = int(np.abs(c).max()) if c.size else 0
    if c.dtype != object and most * most * c.shape[1] < 1 << 63:
        x = pa.array((c * c).sum(1))
        return x, x.cast(pa.decimal128(38, 0))
    c = c.astype(object)
    x = (c * c).sum(1).tolist()
    return pa.array([v if v < 1 << 63 else None for v in x], pa.int64()), pa.array([Decimal(v) if v < 10**38 else None for v in x], pa.decimal128(38, 0))


def identity_errors(fit_rows: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """For each length, the largest absolute entry of the whitened fit list's covariance minus the identity."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, q in unpacked(b):
                w = projected(centred(q, fits[d]), fits[d])
                w = np.hstack([w, np.ones((len(w), 1))])
                total[d] = w.T @ w + total.get(d, 0)
        for d, m in total.items():
            i, j = np.indices(m.shape).reshape(2, -1).astype(np.int32)
            yield pa.RecordBatch.from_pydict({"dim": pa.array(np.full(m.size, d, np.int32)), "i": pa.array(i), "j": pa.array(j), "value": pa.array(m.ravel())})

    found: dict[int, np.ndarray] = {}
    for r in fit_rows.mapInArrow(moments, "dim int, i int, j int, value double").groupBy("dim", "i", "j").agg(F.sum("value").alias("value")).collect():
        k = len(fits[r["dim"]].spread)
        found.setdefault(r["dim"], np.zeros((k + 1, k + 1)))[r["i"], r["j"]] = r["value"] / fits[r["dim"]].n
    # values are centred before they are multiplied; what is left of their mean is rounding
    # rounded, so that the order of summing doesn't show
    return {d: round(float(np.abs(m[:-1, :-1] - np.outer(m[:-1, -1], m[:-1, -1]) - np.eye(len(m) - 1)).max(initial=0)), 12) for d, m in found.items()}


WHITENED = "vec_id long, n long, deviation long, deviation_exact decimal(38,0), whitened array<double>, explained array<double>, identity_error double"


def whitening(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """One row for each valid row of ``vectors`` (vec_id, embedding): its whitened components, in falling order of their eigenvalue."""
    spark = vectors.sparkSession
    prepare(spark)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fit_rows = stage(fit_list(vectors), "whitening-fit")
    fits = {d: components(spark, n, s, g, most) for d, (n, s, g) in sums(fit_rows).items()}
    errors = identity_errors(fit_rows, fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(x: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))

        for b in batches:
            for d, rows, q in whole(b):
                fit = fits[d]
                c = centred(q, fit)
                long, exact = deviations(c)
                yield pa.RecordBatch.from_arrays(
                    [column(b, "vec_id").take(pa.array(rows)), pa.array(np.full(len(q), fit.n)), long, exact, lists(projected(c, fit)), lists(np.tile(fit.explained, (len(q), 1))), pa.array(np.full(len(q), errors[d]))],
                    names=[x.split()[0] for x in WHITENED.split(", ")],
                )

    return vectors.mapInArrow(run, WHITENED)


def whitened_rows(vectors: DataFrame) -> DataFrame:
    """``whitening`` with one row for each vector and component (from 1)."""
    out = whitening(vectors)
    at = out.select("*", F.posexplode("whitened").alias("place", "value"))
    return at.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("value").alias("whitened"), F.element_at("explained", F.col("place") + 1).alias("explained"), "identity_error")
