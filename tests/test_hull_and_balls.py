"""The pruned searches of the farthest pair against brute force: convex hulls, ball tree."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from dispersa.operators import balls, diameter, hull, pairs
from tests.conftest import points_df
from tests.test_points import bf_farthest_pair, frame, random_points

T = np.random.default_rng(5).uniform(0, 2 * math.pi, 1200)
R = np.random.default_rng(6).uniform(size=(1200, 2))
SETS = {
    "uniform": R,
    "lattice": np.floor(R * 9),
    "circle": np.c_[np.cos(T), np.sin(T)],
    "polygon": np.c_[np.cos(np.arange(1200) * math.pi / 600), np.sin(np.arange(1200) * math.pi / 600)],
    "far away": np.c_[np.cos(T), np.sin(T)] * 1e-3 + 1e6,
    "line": np.c_[T, 3 * T + 1],
    "level line": np.c_[T, 0 * T],
    "upright line": np.c_[0 * T, T],
    "sliver": np.c_[T, 3 * T + 1e-6 * R[:, 0]],
    "one place": np.ones((1200, 2)),
    "two places": np.repeat([[0.0, 0.0], [1.0, 1.0]], 600, axis=0),
    "tight clusters": np.repeat(R[:30], 40, axis=0) + 1e-13 * np.random.default_rng(7).normal(size=(1200, 2)),
    "parallel edges": np.r_[np.c_[np.linspace(0, 1, 600), np.linspace(0, 1, 600)], np.c_[np.linspace(0, 1, 600), np.linspace(1, 2, 600)]],
}


def exact(ids, x):
    """Farthest pair of all pairs, vectorised (same arithmetic as a loop)."""
    i, j = np.triu_indices(len(ids), 1)
    dx, dy = x[i, 0] - x[j, 0], x[i, 1] - x[j, 1]
    d = dx * dx + dy * dy
    top = np.flatnonzero(d == d.max())
    low, high = np.minimum(ids[i[top]], ids[j[top]]), np.maximum(ids[i[top]], ids[j[top]])
    at = np.lexsort((high, low))[0]
    return float(d.max()), int(low[at]), int(high[at])


@pytest.mark.parametrize("name", sorted(SETS))
def test_hull_in_parts_equals_all_pairs(name):
    x = SETS[name]
    ids = np.random.default_rng(8).permutation(len(x)) * 3 + 5
    whole = hull._Border()
    for part in np.array_split(np.arange(len(x)), 7):
        one = hull._Border()
        one.add(ids[part], x[part])
        one.reduce()
        whole.add(one.ids, one.x)
    whole.reduce()
    assert whole.ok and hull.calipers(whole.ids, whole.x) == exact(ids, x)
    if name in ("uniform", "lattice", "line", "level line", "one place", "sliver"):
        assert len(whole.ids) < 40  # inner points are gone


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), min_size=2, max_size=40), st.sampled_from([1.0, 0.1, 1e100]),
       st.booleans(), st.integers(0, 10))
def test_hull_ties(places, scale, turned, seed):
    x = np.array(places, float) * scale
    if turned:
        x = x @ np.array([[0.6, 0.8], [-0.8, 0.6]])
    ids = np.random.default_rng(seed).permutation(len(x))
    one = hull._Border()
    one.add(ids, x)
    one.reduce()
    assert hull.calipers(one.ids, one.x) == exact(ids, x)


@pytest.mark.parametrize("name", ["lattice", "polygon", "one place"])
def test_farthest_pair_2d_runs_no_block_kernel(spark, monkeypatch, name):
    x = SETS[name]
    ids = np.random.default_rng(9).permutation(len(x)).tolist()
    df = points_df(spark, x.tolist(), ids).repartition(6)
    monkeypatch.setattr(pairs, "block_pairs", lambda *a, **k: pytest.fail("block kernel"))
    r = diameter.farthest_pair(df).first()
    assert (r["sqdist"], r["i"], r["j"]) == exact(np.array(ids), x)
    assert diameter.exact_diameter(df).first()["max_dist"] == r["dist"] == math.sqrt(r["sqdist"])


def test_large_or_extreme_hulls_take_the_general_way(spark, monkeypatch):
    P = {i: [float(v) for v in p] for i, p in enumerate(SETS["circle"][:60])}
    want = bf_farthest_pair(P)
    monkeypatch.setattr(hull, "BORDER_MAX", 20)
    assert hull.farthest_pair(frame(spark, P)) is False
    fp = diameter.farthest_pair(frame(spark, P)).first()
    assert (fp["sqdist"], fp["i"], fp["j"]) == want
    monkeypatch.undo()
    odd = points_df(spark, [[0.0, 0.0], [3.0, 4.0], [float("nan"), 1.0], [float("inf"), 0.0]])
    assert diameter.exact_diameter(odd).first()["max_dist"] == math.inf
    nan = points_df(spark, [[0.0, 0.0], [3.0, 4.0], [float("nan"), 100.0]])
    assert diameter.exact_diameter(nan).first()["max_dist"] == 5.0
    assert diameter.farthest_pair(points_df(spark, [[float("nan"), 0.0], [1.0, 1.0]])).count() == 0


def clustered(seed, n, dim, clusters=12, spread=0.02):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(clusters, dim))
    X = at[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dim))
    X[: n // 10] = X[0]  # one point that many rows share
    ids = rng.permutation(n)
    return {int(i): [float(v) for v in x] for i, x in zip(ids, X.round(3))}


@pytest.mark.parametrize("seed,dim", [(1, 3), (2, 10), (3, 64)])
def test_ball_tree_opens_few_pairs_and_is_exact(spark, monkeypatch, seed, dim):
    monkeypatch.setattr(pairs, "MAX_BLOCK", 16)
    P = clustered(seed, 500, dim)
    df = frame(spark, P).repartition(5)
    found = diameter.ball_search(df)
    assert found.reason is None and found.opened / found.pairs < 0.3, (found.opened, found.pairs)
    want = bf_farthest_pair(P)
    r = pairs.best_of(found.best).first()
    assert (r["sqdist"], r["i"], r["j"]) == want
    monkeypatch.setattr(diameter, "farthest_pair_candidates", lambda *a, **k: pytest.fail("not the tree"))
    r = diameter.farthest_pair(df).first()
    assert (r["sqdist"], r["i"], r["j"]) == want
    assert diameter.exact_diameter(df).first()["max_dist"] == math.sqrt(want[0])


def test_points_that_balls_cannot_separate_fall_back(spark, monkeypatch):
    monkeypatch.setattr(pairs, "MAX_BLOCK", 16)
    rng = np.random.default_rng(4)
    X = rng.normal(size=(200, 64))
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    P = {i: [float(v) for v in x] for i, x in enumerate(X)}
    found = diameter.ball_search(frame(spark, P))
    assert found.best is None and "not separable" in found.reason and found.opened > found.pairs / 2
    r = diameter.farthest_pair(frame(spark, P)).first()
    assert (r["sqdist"], r["i"], r["j"]) == bf_farthest_pair(P)


def test_ball_tree_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(pairs, "MAX_BLOCK", 8)
    places = [[float(a), float(b), float(c)] for a, b, c in itertools.product((0, 50), repeat=3)]
    P = {i: places[i % 8] if i % 3 else [25.0, 25.0, 25.0] for i in range(150)}
    r = diameter.farthest_pair(frame(spark, P)).first()
    assert (r["sqdist"], r["i"], r["j"]) == bf_farthest_pair(P)
    same = {i: [1.0, 2.0, 3.0] for i in range(40)}
    r = diameter.farthest_pair(frame(spark, same)).first()
    assert (r["sqdist"], r["i"], r["j"]) == (0.0, 0, 1)


def test_leaf_sizes():
    assert balls.leaf_count(10 ** 9, 64) == balls.LEAVES_MAX and balls.leaf_count(2, 3) == 2
    assert balls.sample_size(10 ** 9, 64) * 64 <= balls.SAMPLE_CELLS
    tree = balls.build(np.zeros((1, 5)), 8)
    assert tree.depth == 0 and (balls.leaf_of(tree, np.ones((3, 5))) == 0).all()
    assert random_points(1, 3, 2)
