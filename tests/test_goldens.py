
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from dispersa.operators import diameter, diversity, kcenter, pairs, words
from dispersa.sources import tables

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def emb(spark):
    return tables.embedding_points(spark, SF).persist()


def test_document_goldens(spark):
    lines = words.lines(tables.documents(spark, SF))
    wc = words.word_count(lines)
    agg = wc.agg(F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("tokens"),
                 F.sum(F.length("word")).alias("len_sum")).first()
    assert (agg["distinct"], agg["tokens"], agg["len_sum"]) == (93796, 390171, 729457)
    assert words.average_word_length(wc).first()["avg_len"] == 7


def test_embedding_diameter_golden(emb):
    fp = pairs.farthest_pair(emb).first()
    assert (fp["i"], fp["j"]) == (139, 220)
    assert fp["dist"] == pytest.approx(1.759898122771668, abs=1e-15)


def test_k_center_golden(emb, monkeypatch):
    want = [0, 188, 291, 152, 366]
    assert [r["id"] for r in kcenter.farthest_first(emb, 5).orderBy("ord").collect()] == want
    monkeypatch.setattr(kcenter, "CENTRE_CELLS", 0)
    assert [r["id"] for r in kcenter.farthest_first(emb, 5).orderBy("ord").collect()] == want


def test_core_set_golden(emb):
    core = diversity.core_set(emb, 3, 4, partitioning="modulo").collect()
    got = {p: [r["id"] for r in sorted((r for r in core if r["part"] == p), key=lambda r: r["ord"])] for p in range(4)}
    assert got == {0: [0, 188, 192], 1: [1, 389, 273], 2: [2, 138, 422], 3: [3, 311, 475]}


def test_matching_golden_on_first_hundred(emb):
    sub = emb.where(F.col("id") < 100)
    got = {r["id"]: r["round"] for r in diversity.greedy_matching(sub, 5).collect()}
    assert got == {12: 1, 29: 1, 42: 2, 65: 2, 0: 3}


def test_sample_golden(emb):
    assert [i for i, _ in diameter.sample_points(emb, 5, 42)] == [47, 19, 139, 213, 140]


@pytest.mark.parametrize("shuffle_parts", [1, 4, 13])
def test_point_placement_independence(spark, emb, shuffle_parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_parts))
    try:
        spread = emb.repartition(shuffle_parts)
        fp = pairs.farthest_pair(spread).first()
        assert (fp["i"], fp["j"]) == (139, 220)
        got = {r["id"]: r["round"] for r in diversity.diversity_maximization(spread, 5, 4).collect()}
        base = {r["id"]: r["round"] for r in diversity.diversity_maximization(emb, 5, 4).collect()}
        assert got == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
