"""Class-count operators against a plain-Python model on generated objects (negative ids,
duplicates, ties), for several K and both deterministic partition schemes."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings, strategies as st

from dispersa.operators import counts

OBJECTS = st.lists(st.tuples(st.integers(-50, 50), st.sampled_from(["a", "b", "c", "d"])), min_size=1, max_size=40)


def java_rem(a: int, b: int) -> int:
    return int(math.fmod(a, b))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(objs=OBJECTS, K=st.integers(1, 9), scheme=st.sampled_from(["modulo", "sqrt"]))
def test_counts_match_model(spark, objs, K, scheme):
    df = spark.createDataFrame(objs, "obj_id bigint, class string")
    J = K if scheme == "modulo" else math.isqrt(K)
    partials = {}
    for i, c in objs:
        key = (java_rem(i, J), c)
        partials[key] = partials.get(key, 0) + 1
    totals = {}
    for (p, _), n in partials.items():
        totals[p] = totals.get(p, 0) + n
    per_class = {}
    for (p, c), n in partials.items():
        n0, m0 = per_class.get(c, (0, 0))
        per_class[c] = (n0 + n, max(m0, totals[p]))

    got = {(r["part"], r["class"]): r["n"] for r in counts.class_partials(df, K, scheme).collect()}
    assert got == partials
    assert [tuple(r) for r in counts.class_count(df, K, scheme).collect()] == sorted(
        (c, n) for c, (n, _) in per_class.items())
    stats = {r["class"]: (r["n"], r["max_part"]) for r in counts.class_partition_stats(df, K, scheme).collect()}
    assert stats == per_class
    assert counts.max_partition_size(df, K, scheme).first()["max_part"] == max(totals.values())
    top = max(per_class.items(), key=lambda kv: (kv[1][0], [-ord(ch) for ch in kv[0]]))
    assert tuple(counts.most_frequent_class(df, K, scheme).first()) == (top[0], top[1][0])
