"""The queries opN_<name> of this subpackage: each applies its operator to whole tables with production
parameters. ``QUERIES`` maps names to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispersa.llm import (attention_lm, chat_windows, decontamination, jaccard_groups, line_crf, prefix_trie, quality_rules,
                          sentencepiece_codec, sharding, suffix_dedup, token_files, url_filter, whitening)
from dispersa.llm.shared import small_batches
from dispersa.sources import tables


TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def vocabulary(name: str) -> str:
    """Path of a vocabulary file: from the installed package if there is one, else from TOKENIZER_DIR."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join(TOKENIZER_DIR, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return tables.table(spark, sf_dir, name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.match_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = attention_lm.fold("doc_id", 10) == 0
    scored = attention_lm.score_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


URL_RULES = [url_filter.Rule(*r) for r in (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
    ("com/de/", "block"))]
SHARD_BYTES = 1 << 20


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_lines(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = token_files.token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)
    return token_files.digests(tokens)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"), length=400, words=51)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = line_crf.train(docs, labels.filter(line_crf.fold("doc_id", 3) != 1))
    scored = line_crf.score_documents(docs, model)
    return scored.select("doc_id", (line_crf.fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op10_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups.near_duplicates(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"), components=16, scale=64, offset=1_000_000)
    return whitened.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))  # NULL beyond a long


def op12_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat_windows.read_back(chat_windows.format_windows(rows, budget=1024, history=256))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuild(table(spark, sf_dir, "conversations"), every=20, borrowed=4))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_attention_lm": op2_attention_lm,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_sharding": op5_sharding,
    "op6_token_files": op6_token_files,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_line_crf": op9_line_crf,
    "op10_jaccard_groups": op10_jaccard_groups,
    "op11_whitening": op11_whitening,
    "op12_chat_windows": op12_chat_windows,
    "op13_prefix_trie": op13_prefix_trie,
}
