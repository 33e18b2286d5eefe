"""Class counts: known answers on an invented example, ties, and placement independence."""

from __future__ import annotations

import math

import pytest

from dispersa.operators import counts

# 23 invented objects: class by a rule of the id, so that counts are uneven and known.
COLOURS = ("ochre", "teal", "plum", "ivory")
EXAMPLE = [COLOURS[0 if i % 2 else i // 2 % 3 + (i % 7 == 0)] for i in range(23)]
GOLDEN = sorted({c: EXAMPLE.count(c) for c in EXAMPLE}.items())
TOP = max(GOLDEN, key=lambda x: x[1])


@pytest.fixture
def objects(spark):
    return spark.createDataFrame(list(enumerate(EXAMPLE)), "obj_id bigint, class string")


@pytest.mark.parametrize("scheme,K", [("modulo", 4), ("sqrt", 16), ("physical", 3), ("modulo", 1)])
def test_class_count_golden(objects, scheme, K):
    got = [tuple(r) for r in counts.class_count(objects, K, scheme, repartition=True).collect()]
    assert got == GOLDEN  # sorted by class


def test_partials_and_partition_stats(objects):
    partials = {(r["part"], r["class"]): r["n"] for r in counts.class_partials(objects, 4).collect()}
    expected = {}
    for i, c in enumerate(EXAMPLE):
        expected[(i % 4, c)] = expected.get((i % 4, c), 0) + 1
    assert partials == expected
    sizes = {p: sum(1 for i in range(len(EXAMPLE)) if i % 4 == p) for p in range(4)}
    stats = {r["class"]: (r["n"], r["max_part"]) for r in counts.class_partition_stats(objects, 4).collect()}
    for cls, n in GOLDEN:
        holding = [p for (p, c) in expected if c == cls]
        assert stats[cls] == (n, max(sizes[p] for p in holding))
    assert counts.max_partition_size(objects, 4).first()["max_part"] == 6


def test_max_partition_size_bounds(objects):
    for K in (1, 2, 3, 7, 23):
        m = counts.max_partition_size(objects, K).first()["max_part"]
        assert math.ceil(23 / K) <= m <= 23


def test_most_frequent_class_and_ties(spark, objects):
    assert tuple(counts.most_frequent_class(objects).first()) == TOP
    tied = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "a")], "obj_id bigint, class string")
    assert tuple(counts.most_frequent_class(tied, 2).first()) == ("a", 2)


def test_negative_ids_keep_sign(spark):
    df = spark.createDataFrame([(-7, "x"), (7, "x")], "obj_id bigint, class string")
    parts = sorted(r["part"] for r in counts.class_partials(df, 3).collect())
    assert parts == [-1, 1]


def test_balanced_repartition(spark):
    df = spark.range(1000).withColumnRenamed("id", "obj_id")
    sizes = [r["n"] for r in counts.balanced_repartition(df, 7).collect()]
    assert sum(sizes) == 1000 and len(sizes) == 7
    assert max(sizes) - min(sizes) <= df.rdd.getNumPartitions() + 1


@pytest.mark.parametrize("shuffle_parts", [1, 4, 13])
def test_placement_independence(spark, objects, shuffle_parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_parts))
    try:
        assert [tuple(r) for r in counts.class_count(objects.repartition(5), 4).collect()] == GOLDEN
        assert [tuple(r) for r in counts.class_count(objects, 4, "physical").collect()] == GOLDEN
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_partition_stats_with_physical_parts(spark, objects):
    stats = {r["class"]: (r["n"], r["max_part"]) for r in
             counts.class_partition_stats(objects.repartition(3), 3, "physical").collect()}
    assert {c: n for c, (n, _) in stats.items()} == dict(GOLDEN)
    assert all(1 <= m <= 23 for _, m in stats.values())
    with pytest.raises(ValueError):
        counts.class_count(objects, 4, "ranges")
    with pytest.raises(ValueError):
        counts.class_count(objects, 0)


def test_empty_inputs(spark):
    from dispersa.operators import words

    objs = spark.createDataFrame([], "obj_id bigint, class string")
    assert counts.class_count(objs, 4).count() == 0
    assert counts.class_partition_stats(objs, 4).count() == 0
    assert counts.most_frequent_class(objs).count() == 0
    assert counts.max_partition_size(objs, 4).first()["max_part"] is None
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    lines = words.lines(docs)
    assert words.word_count(lines).count() == 0
    assert words.document_count(lines).first()["n"] == 0
    assert words.blob_line_count(docs).first()["n"] == 0
    assert words.distinct_word_count(lines).first()["n"] == 0
    assert words.average_word_length(words.word_count(lines)).first()["avg_len"] is None


def test_null_ids_are_kept_alike(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (None, "a"), (2, "b")], "obj_id bigint, class string")
    want = {"a": 3, "b": 1}
    assert {r["class"]: r["n"] for r in counts.class_count(df, 4).collect()} == want
    stats = {r["class"]: (r["n"], r["max_part"]) for r in counts.class_partition_stats(df, 4).collect()}
    assert stats == {"a": (3, 1), "b": (1, 1)}
    assert tuple(counts.most_frequent_class(df, 4).first()) == ("a", 3)


def test_repartition_report(spark):
    r = counts.repartition_report(spark.range(0, 1000, 1, 4), 7).first()
    assert (r["parts"], r["n"], r["even_share"], r["balanced"]) == (7, 1000, 143, True)
    none = counts.repartition_report(spark.range(0), 7).first()
    assert (none["parts"], none["n"], none["balanced"]) == (0, 0, True)
    with pytest.raises(ValueError):
        counts.repartition_report(spark.range(5), 0)
