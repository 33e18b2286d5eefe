from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from dispersa.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n long, component string, whitened int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], SCHEMA)


def brute(rows, scale=64, offset=1_000_000):
    """Integer codes, size of the fit list, deviations and covariance in exact arithmetic."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    coded = [(i, tuple(math.floor(scale * float(np.float32(c))) + offset for c in v)) for i, v in kept]
    fit = sorted({x for _, x in coded})
    n, width = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(width)]
    dev = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in coded]
    cov = [[Fraction(sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for x in fit), n ** 3) for b in range(width)]
           for a in range(width)]
    return coded, n, sums, dev, np.array([[float(c) for c in r] for r in cov])


def check(got, rows, components):
    coded, n, sums, dev, cov = brute(rows)
    width = len(sums)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, width)
    assert len(got) == k * len(coded)
    assert sorted(((r.vec_id, int(r.deviation)) for r in got if r.component == 1), key=str) == sorted(dev, key=str)
    centred = {}
    for i, x in coded:
        centred.setdefault(i, []).append(np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)]))
    for c in range(1, k + 1):
        want = defaultdict(list)
        for i, vs in centred.items():
            want[i] = sorted(v @ vectors[:, c - 1] / math.sqrt(values[c - 1]) for v in vs)
        have = defaultdict(list)
        for r in got:
            if r.component == c:
                have[r.vec_id].append(r.whitened)
                assert r.n == n and abs(r.explained - values[c - 1] / np.trace(cov)) < 1e-9 and r.identity_error < 1e-9
        same = all(np.allclose(sorted(have[i]), want[i], atol=1e-6) for i in want)
        turned = all(np.allclose(sorted(have[i]), sorted(-np.array(want[i])), atol=1e-6) for i in want)
        assert have.keys() == want.keys() and (same or turned)


def vectors(n, width, seed=3):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, width)) * (1 + np.arange(width)) / width
    return [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]


def test_whitening_equals_exact_arithmetic(spark):
    rows = vectors(300, 7)
    rows += [(1000, None), (1001, [None] + [0.1] * 6), (1002, [math.nan] + [0.1] * 6), (1003, [math.inf] * 7), (1004, [])]
    rows += [(7, rows[7][1]), (None, rows[9][1])] + [(2000 + i, rows[3][1]) for i in range(200)]  # a repeated vector
    check(W.whiten(frame(spark, rows).repartition(5)).collect(), rows, 16)


def test_first_components_and_far_codes(spark):
    rows = [(i, [1e7 * c for c in v]) for i, v in vectors(60, 5, seed=8)]  # codes beyond 2**29
    check(W.whiten(frame(spark, rows), components=2).collect(), rows, 2)


@pytest.mark.parametrize("top", [1, 255, (1 << 34) + 12345])
def test_bit_sliced_scatter(top):
    rng = np.random.default_rng(top % 97)
    codes = rng.integers(-top, top + 1, (130, 4))
    codes[:, 2] = 5
    sums, cross = W.bit_sliced(codes)
    exact = codes.astype(object)
    assert sums == exact.sum(axis=0).tolist()
    assert (cross == np.triu(exact.T @ exact)).all()


def test_without_variance(spark):
    got = W.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error)
            for r in sorted(got)] == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    got = W.whiten(frame(spark, [(i, [float(i), 1.0]) for i in range(4)])).collect()  # a constant dimension
    assert {r.whitened is None for r in got if r.component == 2} == {True}
    assert all(r.whitened is not None and abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-12
               for r in got if r.component == 1)


def test_empty_and_other_widths(spark):
    empty = W.whiten(frame(spark, [(1, None)]).where("vec_id > 5"))
    assert empty.count() == 0 and empty.columns[:2] == ["vec_id", "component"]
    with pytest.raises(Exception, match="different widths"):
        W.whiten(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()
