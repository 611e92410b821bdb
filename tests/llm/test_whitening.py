"""Whitening against a plain eigenvalue decomposition with exact sums."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from lossledger.llm import whitening

RNG = np.random.default_rng(3)


def plain(rows, components=4):
    """Distinct vectors, covariance with exact entries, eigenvectors in double precision."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = {}
    for x in {tuple(x) for _, x in kept}:
        lengths.setdefault(len(x), []).append(x)
    distinct = max(lengths.values(), key=lambda v: (len(v), len(v[0])))
    n, d = len(distinct), len(distinct[0])
    sums = [sum(x[j] for x in distinct) for j in range(d)]
    gaps = [[n * x[j] - sums[j] for j in range(d)] for x in distinct]
    cov = np.array([[float(Fraction(sum(g[i] * g[j] for g in gaps), n**3)) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in kept:
        if len(x) == d:
            centred = np.array([float(Fraction(n * x[j] - sums[j], n)) for j in range(d)])
            deviation = sum((n * x[j] - sums[j]) ** 2 for j in range(d))
            for k in range(min(components, d)):
                if values[k] > 1e-12 * values[0]:
                    out.setdefault((i, k + 1), []).append((n, deviation, float(centred @ vectors[:, k] / math.sqrt(values[k])), values[k] / np.trace(cov)))
    return out


def check(rows, got, tolerance=1e-8):
    want = plain(rows)
    have = {}
    for r in got:
        have.setdefault((r.vec_id, r.component), []).append(r)
    assert {k: len(v) for k, v in have.items()} == {k: len(v) for k, v in want.items()}
    for component in {k for _, k in want}:
        keys = [k for k in want if k[1] == component]
        ours, theirs = np.array([have[k][0].whitened for k in keys]), np.array([want[k][0][2] for k in keys])
        sign = 1 if abs(ours - theirs).sum() < abs(ours + theirs).sum() else -1
        assert np.allclose(ours * sign, theirs, atol=tolerance, rtol=0)
    for k, rs in have.items():
        for r in rs:
            n, deviation, _, explained = want[k][0]
            assert (r.n, r.deviation) == (n, deviation if deviation < 2**63 else None) and math.isclose(r.explained, explained, rel_tol=1e-9)
            assert r.identity_error < 1e-9


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 3.0, "n") for i, v in rows], "vec_id long, embedding array<float>, whitened double, n string").repartition(5)
    return whitening.whiten(df, **more).collect()


def as_float32(rows):
    return [(i, v if v is None else [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows]


def test_against_plain_with_odd_rows(spark):
    base = (RNG.normal(size=(400, 6)) * [1, 0.7, 0.5, 0.3, 0.1, 0.05] + 3).tolist()
    rows = list(enumerate(base)) + [(1000 + i, base[7]) for i in range(300)]  # a hot vector
    rows += [(None, base[3]), (5, base[5]), (9, base[9]), (2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0, None, 1, 1, 1, 1])]
    rows += [(2004, [math.nan, 0, 0, 0, 0, 0]), (2005, [math.inf, 0, 0, 0, 0, 0]), (2006, [-0.0] * 6), (2007, [0.0] * 6)]
    rows = as_float32(rows)
    check(rows, run(spark, rows))


@pytest.mark.parametrize("scale", [1e-2, 1, 100])
def test_badly_conditioned_and_dependent_dimensions(spark, scale):
    one = RNG.normal(size=(200, 3))
    wide = np.c_[one[:, 0] * 1000 * scale, one[:, 1] * scale, one[:, 2] * scale, np.full(200, 5.0), one[:, 1] * scale]  # one constant, one repeated
    rows = as_float32(list(enumerate(wide.tolist())))
    check(rows, run(spark, rows), 1e-6)


def test_fewer_rows_than_dimensions(spark):
    rows = as_float32(list(enumerate((RNG.normal(size=(3, 8)) * 4).tolist())))
    got = run(spark, rows)
    assert {r.component for r in got} == {1, 2}
    check(rows, got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_variance_gives_no_rows(spark, rows):
    assert run(spark, rows) == []


def test_large_numbers_stay_exact(spark):
    rows = as_float32([(i, [random.Random(i).uniform(-1e9, 1e9), float(i), 0.5 * i * i]) for i in range(50)])
    want, got = plain(rows), run(spark, rows)
    assert {r.vec_id: r.deviation for r in got if r.component == 1} == {k: v[0][1] if v[0][1] < 2**63 else None for (k, c), v in want.items() if c == 1}
