"""Point-set operators against plain-Python brute force on small seeded inputs."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest

from dispersa.operators import diameter, diversity, kcenter, pairs
from tests.conftest import points_df


# --- brute-force models -------------------------------------------------------------------

def sq(a, b):
    s = 0.0
    for x, y in zip(a, b):
        s += (x - y) * (x - y)
    return s


def bf_farthest_pair(P: dict[int, list[float]]):
    best = None
    for i, j in itertools.combinations(sorted(P), 2):
        d = sq(P[i], P[j])
        if best is None or d > best[0]:
            best = (d, i, j)
    return best


def bf_k_center(P: dict[int, list[float]], k: int, first: int):
    chosen = [first]
    md = {i: math.sqrt(sq(P[i], P[first])) for i in P}
    sel = [None]
    for _ in range(1, k):
        cand = [i for i in sorted(P) if i not in chosen]
        m = max(md[i] for i in cand)
        pick = min(i for i in cand if md[i] == m)
        chosen.append(pick)
        sel.append(m)
        for i in P:
            md[i] = min(md[i], math.sqrt(sq(P[i], P[pick])))
    return chosen, sel


def bf_matching(P: dict[int, list[float]], k: int):
    if k >= len(P):
        return {i: 0 for i in P}
    left = set(P)
    out = {}
    for r in range(1, k // 2 + 1):
        best = bf_farthest_pair({i: P[i] for i in left})
        out[best[1]] = r
        out[best[2]] = r
        left -= {best[1], best[2]}
    if k % 2:
        out[min(left)] = k // 2 + 1
    return out


def random_points(seed: int, n: int, dim: int, dups: int = 0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, dim)).round(3)
    if dups:
        X = np.vstack([X, X[rng.integers(0, n, dups)]])
    ids = rng.permutation(np.arange(100, 100 + len(X)) * 3)
    return {int(i): [float(v) for v in x] for i, x in zip(ids, X)}


def frame(spark, P):
    ids = list(P)
    return points_df(spark, [P[i] for i in ids], ids)


@pytest.fixture(params=["one_block", "many_blocks"])
def blocks(request, monkeypatch):
    if request.param == "many_blocks":
        monkeypatch.setattr(pairs, "MAX_BLOCK", 4)
    return request.param


@pytest.fixture(params=["driver", "checkpointed"])
def traversal(request, monkeypatch):
    """Both ways in which a round's centres are detached from the state."""
    if request.param == "checkpointed":
        monkeypatch.setattr(kcenter, "CENTRE_CELLS", 0)
    return request.param


# --- diameter and pairs ---------------------------------------------------------------------

@pytest.mark.parametrize("seed,dim", [(1, 3), (2, 3), (3, 12), (4, 64)])
def test_pair_kernels_against_brute_force(spark, blocks, seed, dim):
    P = random_points(seed, 23, dim, dups=4)
    df = frame(spark, P)
    d, i, j = bf_farthest_pair(P)
    fp = pairs.farthest_pair(df).first()
    assert (fp["i"], fp["j"]) == (i, j) and fp["sqdist"] == d
    assert diameter.exact_diameter(df).first()["max_dist"] == pytest.approx(math.sqrt(d), abs=0)
    allp = [math.sqrt(sq(P[a], P[b])) for a, b in itertools.combinations(P, 2)]
    assert pairs.average_pairwise_distance(df).first()["avg_dist"] == pytest.approx(sum(allp) / len(allp), rel=1e-12)
    m = 3
    got = {}
    for r in pairs.top_partners(df, m).collect():
        got.setdefault(r["i"], []).append((r["sqd"], r["j"]))
    for a in P:
        want = sorted(((sq(P[a], P[b]), b) for b in P if b != a), key=lambda t: (-t[0], t[1]))[:m]
        assert sorted(got[a], key=lambda t: (-t[0], t[1])) == want


def test_square_ties_go_to_smallest_ids(spark, blocks):
    P = {10: [0.0, 0.0], 11: [1.0, 0.0], 12: [0.0, 1.0], 13: [1.0, 1.0], 14: [0.5, 0.5]}
    fp = pairs.farthest_pair(frame(spark, P)).first()
    assert (fp["i"], fp["j"]) == (10, 13)


def test_degenerate_sets(spark):
    empty = points_df(spark, [])
    assert diameter.exact_diameter(empty).first()["max_dist"] == 0.0
    assert pairs.farthest_pair(empty).count() == 0
    assert pairs.average_pairwise_distance(empty).first()["avg_dist"] is None
    one = points_df(spark, [[1.0, 2.0]])
    assert diameter.exact_diameter(one).first()["max_dist"] == 0.0
    same = points_df(spark, [[1.0, 1.0]] * 4)
    assert diameter.exact_diameter(same).first()["max_dist"] == 0.0
    with_nan = points_df(spark, [[0.0, 0.0], [3.0, 4.0], [float("nan"), 1.0]])
    assert diameter.exact_diameter(with_nan).first()["max_dist"] == 5.0
    assert diameter.sampled_diameter(with_nan, 3).first()["max_dist"] == 5.0


def test_mixed_widths_rejected(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0])], "id bigint, p array<double>")
    with pytest.raises(ValueError):
        pairs.farthest_pair(df)
    with pytest.raises(ValueError):
        kcenter.farthest_first(df, 1)


@pytest.mark.parametrize("seed", [4, 5])
def test_sampled_diameter_bounds(spark, seed):
    P = random_points(seed, 30, 4)
    df = frame(spark, P)
    exact = diameter.exact_diameter(df).first()["max_dist"]
    for k in (1, 3, 30):
        s = diameter.sampled_diameter(df, k, seed=seed).first()["max_dist"]
        assert s <= exact + 1e-12 and exact <= 2 * s + 1e-9
    assert diameter.sampled_diameter(df, 30).first()["max_dist"] == pytest.approx(exact, rel=1e-15)
    with pytest.raises(ValueError):
        diameter.sampled_diameter(df, 0)


@pytest.fixture(params=["small_set", "large_set"])
def set_path(request, monkeypatch):
    """Both ways of distances to a set, at their default values and with every set counted as large."""
    if request.param == "large_set":
        monkeypatch.setattr(diameter, "LITERAL_CELLS", 0)
    return request.param


def test_set_distances_against_brute_force(spark, set_path, monkeypatch):
    P = random_points(9, 40, 6)
    df = frame(spark, P)
    cen = diameter.sample_points(df, 4, 42)
    for cells in (diameter.KERNEL_CELLS, 8):  # 8: two points at a time
        monkeypatch.setattr(diameter, "KERNEL_CELLS", cells)
        got = {(r["i"], r["j"]): r["sqdist"] for r in diameter.distances_to_set(df, cen).collect()}
        assert got == {(ci, j): sq(cp, P[j]) for ci, cp in cen for j in P}
        near = {r["id"]: r["min_dist"] for r in diameter.min_distance_to_set(df, cen).collect()}
        assert near == {j: math.sqrt(min(sq(cp, P[j]) for _, cp in cen)) for j in P}
        far = diameter.sampled_diameter(df, 4, 42).first()["max_dist"]
        assert far == math.sqrt(max(sq(cp, P[j]) for _, cp in cen for j in P))


def test_set_distances_reject_other_widths_and_skip_nan(spark, set_path):
    cen = [(0, [0.0, 0.0]), (1, [3.0, 4.0])]
    mixed = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)] + [(9, [0.0, 0.0, 1000.0])], "id bigint, p array<double>")
    for call in (lambda: diameter.min_distance_to_set(mixed, cen), lambda: diameter.distances_to_set(mixed, cen),
                 *(lambda seed=seed: diameter.sampled_diameter(mixed, 1, seed) for seed in (1, 2, 3))):
        with pytest.raises(Exception):
            call().collect()
    nan = spark.createDataFrame([(1, [float("nan"), 0.0]), (2, [0.0, 1.0])], "id bigint, p array<double>")
    assert {r["id"]: r["min_dist"] for r in diameter.min_distance_to_set(nan, cen).collect()} == {1: None, 2: 1.0}


def test_loaded_points_of_mixed_widths_are_rejected_everywhere(spark):
    from dispersa.sources.text import parse_points

    lines = spark.createDataFrame([(i, "1,2" if i else "1,2,3") for i in range(6)], "id bigint, value string")
    pts = parse_points(lines)
    for call in (lambda: diameter.exact_diameter(pts), lambda: diameter.farthest_pair(pts), lambda: diameter.sampled_diameter(pts, 2),
                 lambda: diameter.k_center_diameter(pts, 2), lambda: kcenter.farthest_first(pts, 2), lambda: diversity.core_set(pts, 1, 1),
                 lambda: diversity.greedy_matching(pts, 2), lambda: pairs.average_pairwise_distance(pts),
                 lambda: diameter.point_set_summary(pts, 1, 1)):
        with pytest.raises(Exception):
            call().collect()


# --- k-center -------------------------------------------------------------------------------

@pytest.mark.parametrize("seed,k", [(11, 1), (12, 4), (13, 7)])
def test_k_center_against_brute_force(spark, traversal, seed, k):
    P = random_points(seed, 25, 3, dups=5)
    got = kcenter.farthest_first(frame(spark, P), k).orderBy("ord").collect()
    ids, sel = bf_k_center(P, k, min(P))
    assert [r["id"] for r in got] == ids
    assert [r["min_dist"] for r in got] == sel
    dists = [r["min_dist"] for r in got][1:]
    assert all(a >= b for a, b in zip(dists, dists[1:]))  # radii never grow


def test_k_center_checkpointing_path(spark, monkeypatch):
    P = random_points(21, 20, 2)
    got = [r["id"] for r in kcenter.farthest_first(frame(spark, P), 6, checkpoint_every=1).orderBy("ord").collect()]
    assert got == bf_k_center(P, 6, min(P))[0]


def test_k_center_duplicates_and_all_equal(spark, traversal):
    P = {1: [0.0, 0.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}
    got = [r["id"] for r in kcenter.farthest_first(frame(spark, P), 3).orderBy("ord").collect()]
    assert got == [1, 2, 3]


def test_k_center_cover_radius_within_twice_optimum(spark):
    P = random_points(31, 9, 2)
    k = 3
    got = [r["id"] for r in kcenter.farthest_first(frame(spark, P), k).collect()]
    radius = max(min(math.sqrt(sq(P[i], P[c])) for c in got) for i in P)
    best = min(max(min(math.sqrt(sq(P[i], P[c])) for c in C) for i in P) for C in itertools.combinations(P, k))
    assert radius <= 2 * best + 1e-9


def test_k_center_rejects(spark, traversal):
    P = random_points(41, 5, 2)
    with pytest.raises(ValueError):
        kcenter.farthest_first(frame(spark, P), 6)
    with pytest.raises(ValueError):
        kcenter.farthest_first(frame(spark, P), 0)
    nan = points_df(spark, [[0.0, float("nan")], [1.0, 1.0]])
    with pytest.raises(ValueError):
        kcenter.farthest_first(nan, 1)


def test_grouped_k_center_and_seeded_start(spark, traversal):
    P = random_points(51, 40, 2)
    df = frame(spark, P)
    from pyspark.sql import functions as F

    got = kcenter.farthest_first(df.withColumn("part", F.expr("(id div 3) % 3")), 4, by="part").collect()
    for part in range(3):
        sub = {i: p for i, p in P.items() if (i // 3) % 3 == part}
        ids, _ = bf_k_center(sub, 4, min(sub))
        assert [r["id"] for r in sorted((r for r in got if r["part"] == part), key=lambda r: r["ord"])] == ids
    seeded = kcenter.farthest_first(df, 3, first=7).orderBy("ord").collect()
    again = kcenter.farthest_first(df, 3, first=7).orderBy("ord").collect()
    assert [r["id"] for r in seeded] == [r["id"] for r in again]
    assert [r["id"] for r in seeded] == bf_k_center(P, 3, seeded[0]["id"])[0]
    small = df.withColumn("part", F.when(F.col("id") == min(P), 0).otherwise(1))
    with pytest.raises(ValueError):
        kcenter.farthest_first(small, 2, by="part")


def test_k_center_diameter_is_lower_bound(spark):
    P = random_points(61, 30, 3)
    df = frame(spark, P)
    exact = diameter.exact_diameter(df).first()["max_dist"]
    for k in (2, 5):
        assert diameter.k_center_diameter(df, k).first()["max_dist"] <= exact + 1e-12


# --- matching and diversity -----------------------------------------------------------------

@pytest.mark.parametrize("seed,k,dim", [(71, 2, 2), (72, 5, 2), (73, 6, 2), (74, 30, 2), (75, 1, 2), (76, 5, 16), (77, 7, 9)])
def test_greedy_matching_against_brute_force(spark, blocks, seed, k, dim):
    P = random_points(seed, 18, dim, dups=3)
    got = {r["id"]: r["round"] for r in diversity.greedy_matching(frame(spark, P), k).collect()}
    assert got == bf_matching(P, k)


def test_matching_on_coincident_points(spark):
    P = {5: [1.0, 1.0], 6: [1.0, 1.0], 7: [1.0, 1.0], 8: [1.0, 1.0]}
    got = {r["id"]: r["round"] for r in diversity.greedy_matching(frame(spark, P), 3).collect()}
    assert got == {5: 1, 6: 1, 7: 2}


def test_matching_is_half_of_best_subset(spark):
    P = random_points(81, 8, 2)
    k = 4
    got = [r["id"] for r in diversity.greedy_matching(frame(spark, P), k).collect()]
    value = sum(math.sqrt(sq(P[a], P[b])) for a, b in itertools.combinations(got, 2))
    best = max(sum(math.sqrt(sq(P[a], P[b])) for a, b in itertools.combinations(C, 2))
               for C in itertools.combinations(P, k))
    assert len(set(got)) == k and value >= best / 2 - 1e-9


def test_diversity_maximization_pipeline(spark, traversal):
    P = random_points(91, 60, 3)
    df = frame(spark, P)
    k, L = 4, 4
    core = diversity.core_set(df, k, L)
    assert core.count() == L * k
    core_pts = {r["id"]: list(r["p"]) for r in core.collect()}
    ans = diversity.diversity_maximization(df, k, L)
    got = {r["id"]: r["round"] for r in ans.collect()}
    assert got == bf_matching(core_pts, k)
    score = diversity.diversity_score(ans).first()["avg_dist"]
    pairs_ = [math.sqrt(sq(P[a], P[b])) for a, b in itertools.combinations(got, 2)]
    assert score == pytest.approx(sum(pairs_) / len(pairs_), rel=1e-12)


@pytest.mark.parametrize("seed,dim", [(101, 2), (102, 2), (103, 5)])
def test_pivot_pruning_is_exact(spark, monkeypatch, seed, dim):
    monkeypatch.setattr(diameter, "SURVIVOR_SHARE", 1.0)  # always run the filter pass
    P = random_points(seed, 150, dim, dups=15)
    df = frame(spark, P)
    kept, lb, _ = diameter.farthest_pair_candidates(df, pivots=6, seed=seed)
    d, i, j = bf_farthest_pair(P)
    ids = {r["id"] for r in kept.collect()}
    assert lb <= math.sqrt(d) + 1e-12 and {i, j} <= ids
    if dim == 2:
        assert len(ids) < len(P)
    fp = diameter.farthest_pair(df).first()
    assert (fp["i"], fp["j"], fp["sqdist"]) == (i, j, d)
    assert diameter.exact_diameter(df).first()["max_dist"] == math.sqrt(d)


def test_ties_survive_the_gram_candidate_path(spark, blocks):
    pad = [0.0] * 8
    P = {10: [0.0, 0.0] + pad, 11: [1.0, 0.0] + pad, 12: [0.0, 1.0] + pad, 13: [1.0, 1.0] + pad,
         14: [0.5, 0.5] + pad, 15: [1.0, 1.0] + pad}
    df = frame(spark, P)
    fp = pairs.farthest_pair(df).first()
    assert (fp["i"], fp["j"], fp["sqdist"]) == (10, 13, 2.0)
    got = {r["id"]: r["round"] for r in diversity.greedy_matching(df, 4).collect()}
    assert got == bf_matching(P, 4)


@pytest.mark.parametrize("seed,k,dim", [(111, 11, 2), (112, 14, 9)])
def test_matching_rebuilds_partner_lists(spark, monkeypatch, seed, k, dim):
    monkeypatch.setattr(diversity, "PARTNERS_MAX", 3)  # rebuild every 2 rounds
    P = random_points(seed, 30, dim, dups=4)
    got = {r["id"]: r["round"] for r in diversity.greedy_matching(frame(spark, P), k).collect()}
    assert got == bf_matching(P, k)


def test_sample_prefix_filter_is_exact(spark, monkeypatch):
    P = random_points(121, 300, 2)
    df = frame(spark, P)
    import hashlib

    want = sorted(P, key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))[:7]
    monkeypatch.setattr(diameter, "SAMPLE_OVERDRAW", 0.05)  # force retries with wider ranges
    assert [i for i, _ in diameter.sample_points(df, 7, 42)] == want
    monkeypatch.setattr(diameter, "SAMPLE_OVERDRAW", 4)
    assert [i for i, _ in diameter.sample_points(df, 7, 42)] == want
    assert [i for i, _ in diameter.sample_points(df, 500, 42)] == sorted(
        P, key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("small,persist_every,checkpoint_every",
                         [(True, 4, 100), (True, 4, 3), (False, 1, 100), (False, 3, 100), (False, 2, 5), (False, 100, 100)])
def test_k_center_persistence_schedules(spark, monkeypatch, small, persist_every, checkpoint_every):
    if not small:
        monkeypatch.setattr(kcenter, "CACHE_CELLS", 0)
    P = random_points(131, 30, 12, dups=3)
    got = kcenter.farthest_first(frame(spark, P), 9, persist_every=persist_every,
                                 checkpoint_every=checkpoint_every).orderBy("ord").collect()
    ids, sel = bf_k_center(P, 9, min(P))
    assert [r["id"] for r in got] == ids and [r["min_dist"] for r in got] == sel


def test_non_finite_coordinates_in_wide_points(spark, blocks):
    P = random_points(141, 20, 12)
    ids = sorted(P)
    P[ids[0]] = [float("nan")] + P[ids[0]][1:]
    df = frame(spark, P)
    finite = {i: p for i, p in P.items() if i != ids[0]}
    d, i, j = bf_farthest_pair(finite)
    fp = pairs.farthest_pair(df).first()
    assert (fp["i"], fp["j"], fp["sqdist"]) == (i, j, d)
    P[ids[1]] = [float("inf")] + P[ids[1]][1:]
    assert diameter.exact_diameter(frame(spark, P)).first()["max_dist"] == float("inf")


@pytest.mark.parametrize("dim", [3, 12])
def test_large_sets_take_the_cross_block_path(spark, monkeypatch, dim):
    monkeypatch.setattr(pairs, "MAX_BLOCK", 5)        # several blocks on both sides
    P = random_points(151, 40, dim, dups=3)
    df = frame(spark, P)
    small = diameter.sampled_diameter(df, 9, 42).first()["max_dist"]
    cen = diameter.sample_points(df, 9, 42)
    a = {(r["i"], r["j"]): r["sqdist"] for r in diameter.distances_to_set(df, cen).collect()}
    m = {r["id"]: r["min_dist"] for r in diameter.min_distance_to_set(df, cen).collect()}
    monkeypatch.setattr(diameter, "LITERAL_CELLS", 4)  # any sample is now "large"
    assert diameter.sampled_diameter(df, 9, 42).first()["max_dist"] == small
    b = {(r["i"], r["j"]): r["sqdist"] for r in diameter.distances_to_set(df, cen).collect()}
    m2 = {r["id"]: r["min_dist"] for r in diameter.min_distance_to_set(df, cen).collect()}
    assert a == b and m == m2
    cen_df = frame(spark, dict(cen))
    m3 = {r["id"]: r["min_dist"] for r in diameter.min_distance_to_set(df, cen_df).collect()}
    assert m3 == m
    for (ci, cp) in cen:
        for j in P:
            assert b[(ci, j)] == sq(cp, P[j])


def test_core_set_hash_partitioning_and_seeded_start(spark, traversal):
    from pyspark.sql import functions as F

    P = random_points(161, 48, 5)
    df = frame(spark, P)
    core = diversity.core_set(df, 3, 4, partitioning="hash", first=11).collect()
    import hashlib

    parts = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 4 for i in P}
    seeds = {r["id"]: r["h"] for r in df.select("id", F.xxhash64("id", F.lit(11)).alias("h")).collect()}
    for part in set(parts.values()):
        sub = {i: P[i] for i in P if parts[i] == part}
        first = min(sub, key=lambda i: (seeds[i], i))
        want = bf_k_center(sub, 3, first)[0]
        assert [r["id"] for r in sorted((r for r in core if r["part"] == part), key=lambda r: r["ord"])] == want
    with pytest.raises(ValueError):
        diversity.core_set(df, 3, 4, partitioning="range")


def test_groups_with_null_and_short_groups(spark, traversal):
    rows = [(i, [float(i * i % 17), float(i % 5)], "a" if i % 2 else None) for i in range(12)] + [(50, [1.0, 1.0], "b")]
    df = spark.createDataFrame(rows, "id bigint, p array<double>, grp string")
    with pytest.raises(ValueError):
        kcenter.farthest_first(df, 3, by="grp")
    got = kcenter.farthest_first(df, 3, by="grp", short_groups=True).collect()
    for g in ("a", None, "b"):
        sub = {i: p for i, p, x in rows if x == g}
        want = bf_k_center(sub, min(3, len(sub)), min(sub))[0]
        assert [r["id"] for r in sorted((r for r in got if r["grp"] == g), key=lambda r: r["ord"])] == want


@pytest.mark.parametrize("value", [float("nan"), float("inf"), float("-inf")])
def test_non_finite_coordinates_are_rejected(spark, traversal, value):
    df = points_df(spark, [[0.0, 0.0], [1.0, value], [2.0, 2.0], [3.0, 1.0]])
    for call in (lambda: kcenter.farthest_first(df, 2), lambda: diversity.core_set(df, 2, 2), lambda: diversity.greedy_matching(df, 2)):
        with pytest.raises(ValueError):
            call()


@pytest.mark.parametrize("ids", [range(0, 160, 4), range(-20, 20), [7 * i + 3 for i in range(40)]])
def test_parts_do_not_follow_the_ids(spark, ids):
    P = {i: [float(n % 7), float(n * n % 11)] for n, i in enumerate(ids)}
    core = diversity.core_set(frame(spark, P), 3, 4).collect()
    assert {r["part"] for r in core} == {0, 1, 2, 3} and len(core) == 12
    answer = diversity.diversity_maximization(frame(spark, P), 4, 4).collect()
    assert sorted(r["round"] for r in answer) == [1, 1, 2, 2]


def test_a_round_over_many_groups_is_quick(spark):
    import time

    from pyspark.sql import functions as F

    wide = spark.range(12_000).select("id", F.array(*[(F.col("id") * (j + 1) % 97).cast("double") for j in range(64)]).alias("p"),
                                      (F.col("id") % 4000).alias("grp"))
    began = time.time()
    assert kcenter.farthest_first(wide, 2, by="grp").count() == 8000
    assert time.time() - began < 60


def test_block_and_task_sizes_follow_the_width():
    for dim in (1, 64, 4096, 1 << 22):
        assert 1 <= pairs.block_rows(dim) <= pairs.MAX_BLOCK
        assert pairs.block_rows(dim) * dim <= max(pairs.BLOCK_CELLS, dim)
    assert pairs.block_count(10 ** 6, 4096, 8) >= 10 ** 6 // 256
    # On a session that starts with two cores the copies still spread by their size.
    blocks = pairs.block_count(10 ** 6, 64, 2)
    tasks = pairs.task_count(blocks * (blocks + 1) // 2, blocks * 10 ** 6, 64, 2)
    assert blocks * 10 ** 6 * 64 / tasks <= 1.01 * pairs.TASK_CELLS
