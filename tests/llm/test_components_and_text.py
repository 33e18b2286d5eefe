from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from dispersa.llm import text as T
from dispersa.llm.components import connected
from dispersa.llm.shared import RecentCache


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    nodes = rng.sample(range(10_000), 200)
    links = list(zip(nodes[:60], nodes[1:60])) + [(nodes[60], x) for x in nodes[61:150]] + [(nodes[150], nodes[150])]
    got = {r.c: r.label for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[x] for x in nodes[:60]} == {min(nodes[:60])} and {got[x] for x in nodes[60:150]} == {min(nodes[60:150])}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_slices_words_and_fingerprints():
    texts = ["a bb", None, "", " c\n", "a bb"]
    parts = list(T.slices(pa.array(texts), 4))
    assert [p.first for p in parts] == [0, 3, 4] and sum(p.rows for p in parts) == 5
    part = next(T.slices(pa.array(texts)))
    starts, ends, before = T.words(part.data, part.bounds)
    assert before.tolist() == [0, 2, 2, 2, 3, 5]
    names = T.Fingerprints(part.data).of(starts, ends)
    assert names[0] == names[3] and names[1] == names[4] and len(set(names.tolist())) == 3
    one, rows = T.shingles(names, before, 2)
    assert rows.tolist() == [0, 3, 4] and one[0] == one[2] != one[1]


def test_recent_cache_returns_what_make_gives():
    cache, rng = RecentCache(20), random.Random(1)
    for _ in range(200):
        keys = [rng.randrange(100) for _ in range(rng.randint(0, 30))]
        assert cache.get_all(keys, lambda ks: [k * k + 1 for k in ks]) == [k * k + 1 for k in keys]
    assert len(cache.young) + len(cache.old) < 120
    assert np.array(cache.get_all([], lambda ks: [])).size == 0
