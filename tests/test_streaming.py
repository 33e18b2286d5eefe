"""The single-aggregation counting operators run unchanged on a streaming source."""

from __future__ import annotations

import os

import pytest

from dispersa.operators import counts, words

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_word_count_on_a_stream_equals_batch(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "documents.parquet").parquet(SF)
    wc = words.word_count(words.lines(stream.select("doc_id", "text")))
    q = (wc.writeStream.outputMode("complete").format("memory").queryName("wc_stream")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["word"]: r["n"] for r in spark.table("wc_stream").collect()}
    batch = words.word_count(words.lines(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")))
    assert got == {r["word"]: r["n"] for r in batch.collect()}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_class_partials_on_a_stream(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF).selectExpr(
        "event_id AS obj_id", "event_type AS class")
    q = (counts.class_partials(ev, 4).writeStream.outputMode("complete").format("memory")
         .queryName("cp_stream").option("checkpointLocation", str(tmp_path / "ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(tuple(r) for r in spark.table("cp_stream").collect())
    objs = spark.read.parquet(f"{SF}/events.parquet").selectExpr("event_id AS obj_id", "event_type AS class")
    assert got == sorted(tuple(r) for r in counts.class_partials(objs, 4).collect())
