"""Even spread, observed loads, hot-word salting, partition combine, merged core-sets, estimates, draws."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dispersa.operators import candidates, counts, diameter, diversity, pairs, words
from tests.conftest import points_df
from tests.test_plans import _plan
from tests.test_points import frame, random_points, sq


def objects(spark, ids):
    return spark.createDataFrame([(i, f"c{n % 3}") for n, i in enumerate(ids)], "obj_id bigint, class string")


@pytest.mark.parametrize("n,K", [(0, 3), (1, 4), (10, 3), (101, 7), (5, 9)])
def test_even_spread(spark, n, K):
    ids = random.Random(n).sample(range(-500, 500), n)
    df = objects(spark, ids)
    parts = {r["obj_id"]: r["part"] for r in counts.even_spread(df.repartition(5), K).collect()}
    assert parts == {r["obj_id"]: r["part"] for r in counts.even_spread(df.coalesce(1), K).collect()}
    sizes = Counter(parts.values())
    assert len(parts) == n and all(0 <= p < K for p in parts.values())
    assert not n or max(sizes.values()) - min(sizes.get(p, 0) for p in range(K)) <= 1
    assert {(r["part"], r["n"]) for r in counts.even_spread_report(df, K).collect()} == set(sizes.items())


def test_even_spread_of_repeated_and_null_ids(spark):
    df = objects(spark, [None] * 5 + [7] * 8 + [1, 2])
    sizes = Counter(r["part"] for r in counts.even_spread(df, 4).collect())
    assert sorted(sizes.values()) == [3, 4, 4, 4]


@pytest.mark.parametrize("n,K", [(0, 3), (9, 2), (100, 7)])
def test_observed_load_equals_counted_sizes(spark, n, K):
    spread = counts.even_spread(objects(spark, range(n)), K)
    got = counts.observed_load(spread, K, "part").first()
    sizes = Counter(r["part"] for r in spread.collect())
    assert tuple(got) == (len(sizes), n, max(sizes.values(), default=0))
    # Skewed parts: the largest real partition is seen.
    skewed = objects(spark, range(n)).withColumn("part", F.when(F.col("obj_id") < n // 2, 0).otherwise(F.col("obj_id") % K))
    counted = skewed.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    assert counts.observed_load(skewed, K, "part").first()["max_part"] == counted
    round_robin = counts.observed_load(objects(spark, range(n)), K).first()
    assert round_robin["n"] == n and round_robin["max_part"] >= math.ceil(n / K)


def lines(spark, texts):
    return spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "doc_id bigint, line_no int, line string")


TEXTS = ["the " * 50 + f"w{i} w{i % 7}" for i in range(40)] + ["", "  ", "a  b"]


def test_salting_touches_hot_words_only(spark):
    df = lines(spark, TEXTS)
    want = {r["word"]: r["n"] for r in words.word_count(df).collect()}
    assert words.hot_words(df) == ["the"]
    K = 4
    salted = words.word_count_salted(df, K)
    assert {r["word"]: r["n"] for r in salted.collect()} == want
    # Rows of the first round: a plain count's, and at most K for the hot word.
    tok = words.tokens(df)
    deal = F.pmod(F.xxhash64("doc_id", "line_no", F.lit(0)), F.lit(K))
    first = tok.groupBy(F.when(F.col("word") == "the", deal).otherwise(0).alias("s"), "word").count()
    assert len(want) < first.count() <= len(want) - 1 + K
    assert "IN (the)" in _plan(salted) or "= the" in _plan(salted)
    assert words.hot_words(lines(spark, [])) == [] and words.word_count_salted(lines(spark, []), 3).count() == 0
    assert {r["word"]: r["n"] for r in words.word_count_salted(df, K, hot=[]).collect()} == want


def test_partition_combine_moves_no_text(spark, monkeypatch):
    df = lines(spark, TEXTS).repartition(3).cache()
    want = {r["word"]: r["n"] for r in words.word_count(df).collect()}
    parts = words.partition_word_counts(df).collect()
    assert len({r["part"] for r in parts}) == 3 and len({(r["part"], r["word"]) for r in parts}) == len(parts)
    counted = words.word_count_partitioned(df)
    assert {r["word"]: r["n"] for r in counted.collect()} == want
    plan = _plan(words.word_count_partitioned(df)).split("InMemoryTableScan")[0]  # above the cached lines
    assert plan.count("Exchange") == plan.count("Exchange hashpartitioning(word") == 1
    monkeypatch.setattr(words, "COMBINE_WORDS", 2)  # a full combiner hands its counts on
    assert {r["word"]: r["n"] for r in words.word_count_partitioned(df).collect()} == want
    df.unpersist()


def radius(P, centres):
    return max(min(math.sqrt(sq(p, P[c])) for c in centres) for p in P.values())


@pytest.mark.parametrize("seed,dim,chunks", [(1, 2, 1), (2, 2, 5), (3, 8, 4), (4, 1, 7)])
def test_merged_core_set_is_within_four_times_the_exact_radius(spark, seed, dim, chunks):
    P = random_points(seed, 120, dim, dups=20)
    df = frame(spark, P)
    merged = diversity.core_set_merged(df.repartition(7), 4, 2, chunks).collect()
    exact = diversity.core_set(df, 4, 2).collect()
    part = {r["id"]: r["part"] for r in df.withColumn("part", diversity.part_of("id", 2)).collect()}
    for g in (0, 1):
        sub = {i: p for i, p in P.items() if part[i] == g}
        a, b = ([r["id"] for r in rows if r["part"] == g] for rows in (merged, exact))
        assert len(a) == len(b) == 4 and radius(sub, a) <= 4 * radius(sub, b) + 1e-9
        if chunks == 1:
            assert sorted(a) == sorted(b)  # one chunk: the traversal itself
    assert {(r["part"], r["ord"], r["id"]) for r in merged} == {
        (r["part"], r["ord"], r["id"]) for r in diversity.core_set_merged(df, 4, 2, chunks).collect()}


def test_merged_core_set_edges(spark):
    assert diversity.core_set_merged(points_df(spark, []), 3, 2, 2).count() == 0
    few = diversity.core_set_merged(points_df(spark, [[0.0], [1.0]]), 3, 1, 4).collect()
    assert sorted(r["id"] for r in few) == [0, 1]
    for bad in ([[0.0], [float("nan")]], [[0.0], [1.0, 2.0]]):
        with pytest.raises(Exception):
            diversity.core_set_merged(points_df(spark, bad), 2, 1, 1).collect()
    with pytest.raises(ValueError):
        diversity.core_set_merged(points_df(spark, [[0.0]]), 0, 1, 1)
    assert candidates.chunk_count(10 ** 9, 64, 4) * 4 * pairs.BLOCK_CELLS >= 64 * 10 ** 9


def test_rounds_with_few_candidates_a_pass(spark, monkeypatch):
    """Small candidate lists: several passes, bounds that hold rounds back, both distance paths."""
    from tests.test_points import bf_k_center

    monkeypatch.setattr(candidates, "SUMMARY_CELLS", 1)
    monkeypatch.setattr(candidates, "BASE_ROWS", 2)
    for seed, dim in ((1, 2), (2, 12)):
        P = random_points(seed, 200, dim, dups=60)
        from dispersa.operators import kcenter

        got = kcenter.farthest_first(frame(spark, P).repartition(3), 9).orderBy("ord").collect()
        ids, far = bf_k_center(P, 9, min(P))
        assert [r["id"] for r in got] == ids and [r["min_dist"] for r in got] == far


@pytest.mark.parametrize("seed,n,dim", [(1, 2, 3), (2, 60, 2), (3, 2500, 5), (4, 301, 20)])
def test_estimate_is_within_its_bound(spark, seed, n, dim):
    rng = np.random.default_rng(seed)
    X = rng.exponential(size=(n, dim)) ** 2
    df = points_df(spark, X.tolist(), rng.permutation(n).tolist())
    exact = pairs.average_pairwise_distance(df).first()["avg_dist"]
    est = pairs.estimate_average_distance(df.repartition(4), rounds=3, seed=seed).first()
    assert abs(est["avg_dist"] - exact) <= est["error_bound"]
    again = pairs.estimate_average_distance(df.coalesce(1), rounds=3, seed=seed).first()
    assert again["n_pairs"] == est["n_pairs"] and again["avg_dist"] == pytest.approx(est["avg_dist"], rel=1e-12)
    if n > 1000:  # and far closer than the bound in practice
        assert abs(est["avg_dist"] - exact) < 0.1 * exact


def test_estimate_edges(spark):
    assert tuple(pairs.estimate_average_distance(points_df(spark, [[1.0]])).first()) == (None, None, 0)
    same = pairs.estimate_average_distance(points_df(spark, [[1.0, 2.0]] * 9)).first()
    assert same["avg_dist"] == 0.0 and same["error_bound"] == 0.0
    with pytest.raises(ValueError):
        pairs.estimate_average_distance(points_df(spark, [[1.0], [float("inf")]]))


def test_draws_with_replacement(spark):
    P = random_points(5, 40, 2)
    df = frame(spark, P)
    draws = {r["draw"]: r["id"] for r in diameter.sample_with_replacement(df.repartition(3), 400, 9).collect()}
    assert sorted(draws) == list(range(400)) and set(draws.values()) == set(P)  # all seen, many again
    assert draws == {r["draw"]: r["id"] for r in diameter.sample_with_replacement(df.coalesce(1), 400, 9).collect()}
    seen = Counter(draws.values())
    assert max(seen.values()) < 30  # near 10 each
    few = {r["id"] for r in diameter.sample_with_replacement(df, 5, 1).collect()}
    want = max(math.sqrt(sq(P[i], q)) for i in few for q in P.values())
    assert diameter.replaced_sample_diameter(df, 5, 1).first()["max_dist"] == want
    empty = points_df(spark, [])
    assert diameter.sample_with_replacement(empty, 3, 1).count() == 0
    assert diameter.replaced_sample_diameter(empty, 3, 1).first()["max_dist"] == 0.0
    with pytest.raises(ValueError):
        diameter.sample_with_replacement(df, 0, 1)
