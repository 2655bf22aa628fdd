"""Whitening against exact arithmetic in Python and floating-point eigenvectors."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from blockbeam.llm import whitening as W

KIND = "vec_id long, embedding array<double>"


def integers(v):
    return tuple(math.floor(64 * c) + 1_000_000 for c in v)


def valid(rows):
    return [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]


def check(rows, got, d, rank=None):
    """Hold rows (vec_id, component, n, deviation, whitened, explained, identity_error) against an exact covariance."""
    mine = [(i, integers(v)) for i, v in valid(rows) if len(v) == d]
    fit = np.array(sorted({x for _, x in mine}), object)
    n, total = len(fit), fit.sum(0)
    scatter = sum(np.multiply.outer(n * x - total, n * x - total) for x in fit)  # n^3 times the covariance
    cov = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in scatter])
    values, vectors = np.linalg.eigh(cov)
    k = min(16, d, np.linalg.matrix_rank(cov) if rank is None else rank)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    if not k:
        assert not got
        return
    assert Counter(i for i, _ in mine) == Counter({i: len(c[1]) for i, c in by_id.items()})
    w = {}
    for i, x in mine:
        assert sorted(by_id[i]) == list(range(1, k + 1))
        for j in range(k):
            r = by_id[i][j + 1]
            assert {q.n for q in r} == {n}
            dev = sum(int(n * a - s) ** 2 for a, s in zip(x, total, strict=True))
            assert all(q.deviation == (dev if dev < 2**63 else None) for q in r) or len(r) > 1
            assert all(abs(q.explained - values[j] / np.trace(cov)) <= 1e-9 * q.explained for q in r)
            assert all(q.identity_error <= 1e-9 for q in r)
            if len(r) == 1:
                w[x, j] = r[0].whitened
    exact = {x: np.array([float(Fraction(int(n * a - s), n)) for a, s in zip(x, total, strict=True)]) for _, x in mine}
    for j in range(k):
        apart = min([abs(values[j] - v) for m, v in enumerate(np.linalg.eigvalsh(cov)[::-1]) if m != j], default=1) / values[0]
        if apart < 1e-6:
            continue  # within a multiple eigenvalue any basis will do
        mine_j = np.array([w[x, j] for _, x in mine if (x, j) in w])
        want = np.array([exact[x] @ vectors[:, j] / math.sqrt(values[j]) for _, x in mine if (x, j) in w])
        assert min(np.abs(mine_j - want).max(), np.abs(mine_j + want).max()) < 1e-6


def test_polynomial_against_fractions():
    """Modular Hessenberg reduction equals the recurrence of Faddeev and LeVerrier, swaps and zero columns included."""
    rnd = random.Random(4)
    for d in (1, 2, 3, 5, 8):
        for sparse in (False, True):
            a = np.array([[0 if sparse and rnd.random() < 0.6 else rnd.randrange(-50, 50) for _ in range(d)] for _ in range(d)], object)
            m, c = np.zeros((d, d), object), [1]
            for k in range(1, d + 1):
                m = a @ m + c[-1] * np.eye(d, dtype=int).astype(object)
                c.append(-int(np.trace(a @ m)) // k)
            p = W.primes_beyond(1)[0]
            assert W.polynomial_mod((a % p).astype(np.int64), p).tolist() == [x % p for x in reversed(c)]


def test_primes_and_remainders():
    assert [x for x in range(2, 200) if W.is_prime(x)] == [x for x in range(2, 200) if all(x % y for y in range(2, x))]
    primes = W.primes_beyond(10**60)
    assert math.prod(primes) > 10**60 and len(set(primes)) == len(primes)
    numbers = [0, 1, 10**60 - 1, 3**100]
    assert W.remaindered([(p, [x % p for x in numbers]) for p in primes]) == numbers


def poly(roots):
    c = [1]
    for r in roots:
        c = [(c[k - 1] if k else 0) - r * (c[k] if k < len(c) else 0) for k in range(len(c) + 1)]
    return c


@pytest.mark.parametrize("roots", [[7], [0, 0, 5], [0, 0, 0], [1, 2, 3, 4, 1000], [5, 5, 5, 9, 9, 2], [10**30, 10**30 + 1, 3], [1, 10**40], [8, 8, 8, 8], [1, 2, 4, 8, 16, 64]])
def test_roots_are_isolated_with_multiplicity(roots):
    got = W.largest_roots(poly(roots), 16)
    want = sorted(Counter(r for r in roots if r).items(), reverse=True)
    assert [x.multiplicity for x in got] == [m for _, m in want]
    for x, (r, _) in zip(got, want, strict=True):
        assert abs(x.value - r) <= Fraction(r, 1 << 90)
    assert W.largest_roots(poly(roots), 2) == got[: len(W.largest_roots(poly(roots), 2))]


def test_irrational_roots():
    """x^2 - 4 x + 2 has the roots 2 +- sqrt 2."""
    got = [float(x.value) for x in W.largest_roots([2, -4, 1], 16)]
    assert got == pytest.approx([2 + math.sqrt(2), 2 - math.sqrt(2)], rel=1e-15)


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check(rows, W.whitened_rows(df).collect(), 64)


def test_close_and_multiple_eigenvalues(spark):
    # the corners of a cross: all eigenvalues equal but one, which differs by little
    rows = [(2 * i + k, [(1000.0 + (i == 3) / 64) * s if j == i else 0.0 for j in range(6)]) for i in range(6) for k, s in enumerate((1, -1))]
    got = W.whitened_rows(spark.createDataFrame(rows, KIND)).collect()
    check(rows, got, 6)
    assert len(got) == 12 * 6


def test_rank_below_dimension(spark):
    rnd = random.Random(2)
    base = [[rnd.randrange(-9, 9) for _ in range(20)] for _ in range(3)]
    rows = [(i, [float(sum(rnd_k * b for rnd_k, b in zip(k, col, strict=True))) for col in zip(*base, strict=True)]) for i in range(40) for k in [[rnd.randrange(-5, 5) for _ in range(3)]]]
    check(rows, W.whitened_rows(spark.createDataFrame(rows, KIND)).collect(), 20, 3)


def test_odd_rows(spark):
    rnd, nan, inf = random.Random(9), float("nan"), float("inf")
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(50)]
    rows += [(i, [rnd.gauss(0, 1) for _ in range(3)]) for i in range(100, 120)]
    odd = [(900, None), (901, []), (902, [nan, 1.0, 1.0, 1.0]), (903, [1.0, inf, 1.0, 1.0]), (904, [1.0, None, 1.0, 1.0]), (905, [0.5] * 7), (906, [-inf] * 4)]
    again = [rows[3], rows[3], (77, rows[3][1]), (None, rows[4][1])]
    df = spark.createDataFrame(rows + odd + again, KIND).repartition(3)
    got = W.whitened_rows(df).collect()
    assert {r.vec_id for r in got} == {i for i, _ in rows} | {77, None}  # 905 is the only vector of its length: no component
    four = [r for r in got if r.vec_id is None or r.vec_id < 100]
    check([*rows, *again], four, 4)
    check(rows, [r for r in got if r.vec_id is not None and r.vec_id >= 100], 3)
    assert Counter(r.vec_id for r in four)[3] == 12
    wide = df.selectExpr("*", "'x' as dim", "'y' as code", "1 as n", "2 as at", "null as whitened", "3 as i")
    assert sorted(map(repr, W.whitened_rows(wide).collect())) == sorted(map(repr, got))
    assert W.whitened_rows(df.where("vec_id < 0")).count() == 0
    assert W.whitened_rows(df.where("vec_id = 5")).count() == 0


def test_large_entries(spark):
    """Entries of several limbs, sums beyond 64 bits, and entries that are cut at 2^62."""
    rnd = random.Random(6)
    rows = [(i, [rnd.choice([1e3, 1e9, 1e15]) * rnd.gauss(0, 1) for _ in range(3)]) for i in range(60)]
    got = W.whitened_rows(spark.createDataFrame(rows, KIND)).collect()
    check(rows, got, 3)
    assert any(r.deviation is None for r in got)
    exact = {r.vec_id: r.deviation_exact for r in W.whitening(spark.createDataFrame([(i, [c / 1e10 for c in v]) for i, v in rows], KIND)).collect()}
    assert all(v is not None for v in exact.values())
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], KIND)
    assert max(r.identity_error for r in W.whitened_rows(huge).collect()) < 1e-9


def test_floats_and_partitions(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    one = sorted(map(tuple, W.whitened_rows(df.coalesce(1)).collect()))
    assert one == sorted(map(tuple, W.whitened_rows(df.repartition(7)).collect()))
