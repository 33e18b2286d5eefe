from __future__ import annotations

from collections import Counter, defaultdict

from dispersa.llm import sharding as S
from tests.llm import cases


def test_every_shard_fits_or_is_one_text(spark):
    rows = [(i, "x" * (i * 37 % 400)) for i in range(300)] + [(1000, "y" * 5000), (None, "n" * 90), (9, None)]
    got = S.assign_shards(cases.frame(spark, rows), 1000).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((i, len(t or "")) for i, t in rows)
    shards = defaultdict(list)
    for r in got:
        assert len(r.shard) == r.depth
        shards[r.shard].append(r)
    names = sorted(shards)
    for a, b in zip(names, names[1:]):
        assert not b.startswith(a)  # leaves do not contain each other
    for name, members in shards.items():
        size = sum(r.n_bytes for r in members)
        assert all(r.shard_bytes == size for r in members)
        assert all(r.fits == (size <= 1000) for r in members)
        assert size <= 1000 or len(members) == 1
        # Only buckets over the limit were split: the parent does not fit.
        parent = sum(r.n_bytes for n, m in shards.items() for r in m if name and n.startswith(name[:-1]))
        assert not name or parent > 1000


def test_repeated_rows_are_dealt_over_shards(spark):
    got = S.assign_shards(cases.frame(spark, [(1, "z" * 300)] * 10), 1000).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == 10 and sorted(sizes.values()) == [1, 3, 3, 3] and all(r.fits for r in got)


def test_empty_table_and_awkward_rows(spark):
    assert S.assign_shards(cases.empty(spark), 10).count() == 0
    got = S.assign_shards(cases.frame(spark, cases.awkward()), 1 << 20).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in cases.awkward())


def test_write_shards(spark, tmp_path):
    docs = cases.frame(spark, [(i, "x" * 100) for i in range(40)])
    S.write_shards(docs, S.assign_shards(docs, 1000), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40 and max(r["count"] for r in back.groupBy("shard").count().collect()) <= 10


def test_write_shards_keeps_every_row_once(spark, tmp_path):
    rows = ([(1, "a" * 90), (1, "b" * 90), (None, "c" * 90), (None, "c" * 90), (2, None), (2, None), (3, "")]
            + [(7, "z" * 300)] * 10 + [(i, "y" * (i % 90)) for i in range(20, 90)] + [(8, "w" * 5000)])
    docs = cases.frame(spark, rows).repartition(5)
    shards = S.assign_shards(docs, 1000)
    for n, extra in enumerate((docs, docs.withColumnRenamed("k", "shard"))):
        S.write_shards(extra, shards, str(tmp_path / f"out{n}"))
        folder = "shard" if n == 0 else "_shard"
        back = spark.read.parquet(str(tmp_path / f"out{n}"))
        assert cases.rows_of(back, "doc_id", "text") == Counter(rows)
        sizes, members = Counter(), Counter()
        for r in back.collect():
            sizes[r[folder]] += len(r.text or "")
            members[r[folder]] += 1
        assert all(size <= 1000 or members[name] == 1 for name, size in sizes.items())
        assert set(sizes) == {"s" + r.shard.replace("/", "-") for r in shards.collect()}


def test_a_million_copies_of_one_row(spark, tmp_path):
    docs = spark.range(1_000_000).selectExpr("5L AS doc_id", "'zz' AS text")
    shards = S.assign_shards(docs, 100_000)
    counts = {r.shard: r["count"] for r in shards.groupBy("shard").count().collect()}
    assert len(counts) == 20 and set(counts.values()) == {50_000}
    S.write_shards(docs, shards, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in back) == [50_000] * 20


def test_write_shards_of_an_empty_table(spark, tmp_path):
    S.write_shards(cases.empty(spark), S.assign_shards(cases.empty(spark), 10), str(tmp_path / "out"))
