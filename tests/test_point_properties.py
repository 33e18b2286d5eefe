"""Generated small integer point sets — full of exact distance ties and duplicates — against
the brute-force models, for both traversal paths and several block layouts."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings, strategies as st

from dispersa.operators import diversity, kcenter, pairs
from tests.test_points import bf_farthest_pair, bf_k_center, bf_matching, frame

POINT_SETS = st.integers(2, 4).flatmap(
    lambda dim: st.lists(st.lists(st.integers(-2, 2), min_size=dim, max_size=dim), min_size=6, max_size=14)
).flatmap(lambda pts: st.permutations(list(range(10, 10 + 3 * len(pts), 3))).map(
    lambda ids: {i: [float(v) for v in p] for i, p in zip(ids, pts)}))

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(P=POINT_SETS, block=st.sampled_from([8192, 3]))
def test_farthest_pair_ties(spark, P, block):
    old = pairs.MAX_BLOCK
    pairs.MAX_BLOCK = block
    try:
        d, i, j = bf_farthest_pair(P)
        fp = pairs.farthest_pair(frame(spark, P)).first()
        assert (fp["i"], fp["j"], fp["sqdist"]) == (i, j, d)
    finally:
        pairs.MAX_BLOCK = old


@SETTINGS
@given(P=POINT_SETS, k=st.integers(1, 6), driver=st.booleans())
def test_k_center_ties(spark, P, k, driver):
    from pyspark.sql import functions as F

    old = kcenter.CENTRE_CELLS
    kcenter.CENTRE_CELLS = old if driver else 0
    try:
        k = min(k, len(P))
        got = kcenter.farthest_first(frame(spark, P), k).orderBy("ord").collect()
        ids, sel = bf_k_center(P, k, min(P))
        assert [r["id"] for r in got] == ids and [r["min_dist"] for r in got] == sel
        # grouped: two groups, each traversed on its own
        grouped = frame(spark, P).withColumn("part", F.expr("(id div 3) % 2"))
        sizes = {g: sum(1 for i in P if (i // 3) % 2 == g) for g in (0, 1)}
        kk = min(k, *sizes.values())
        if kk >= 1 and min(sizes.values()) > 0:
            rows = kcenter.farthest_first(grouped, kk, by="part").collect()
            for g in (0, 1):
                sub = {i: p for i, p in P.items() if (i // 3) % 2 == g}
                want = bf_k_center(sub, kk, min(sub))[0]
                assert [r["id"] for r in sorted((r for r in rows if r["part"] == g), key=lambda r: r["ord"])] == want
    finally:
        kcenter.CENTRE_CELLS = old


@SETTINGS
@given(P=POINT_SETS, k=st.integers(1, 9))
def test_matching_ties(spark, P, k):
    got = {r["id"]: r["round"] for r in diversity.greedy_matching(frame(spark, P), k).collect()}
    assert got == bf_matching(P, k)
