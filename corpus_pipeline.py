"""The corpus pipeline: documents go through five stages, each written as Parquet and read again.

    quality rules        rejected documents go, failing lines are cut out of the others
    n-gram Jaccard join  one document of each component of near copies stays (the smallest id); near copies
                         share 80 % of their five-word shingles
    suffix-array dedup   byte strings of 400 and runs of 51 words that occur again are cut out
    decontamination      word runs of benchmark items are cut out; documents that are mostly such runs go
    SentencePiece        ids of the remaining texts: n_tokens and digests of ids and decoded text

All stages but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispersa.llm import decontamination, jaccard_groups, quality_rules, sentencepiece_codec, suffix_dedup
from dispersa.llm.queries import vocabulary
from dispersa.llm.shared import small_batches, written
from dispersa.sources.tables import table

NEAR = jaccard_groups.Join(width=5, percent=80)  # op10's query keeps its own 4 words and 85 %
PASSAGE_WORDS = 51  # most runs of so many words are under op7's 400 bytes


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, where the table has the column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _counted(quality_rules.clean_documents(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard_groups.keep_one(docs, join=NEAR)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _counted(suffix_dedup.remove_repeats(docs, words=PASSAGE_WORDS))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _counted(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return sentencepiece_codec.round_trip(docs, vocabulary("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("jaccard_groups", near_copies),
    ("suffix_dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("sentencepiece", token_ids),
]

# The middle stages are iterative and the last one is a codec, so SQL does not express the whole; tests
# hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
