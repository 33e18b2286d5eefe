"""Word statistics over documents, where — as in the reference — one line is one document.

Three word counts give the same ``(word, n)`` table through different plans:

* ``word_count``: tokens → ``groupBy(word)``; Spark's partial aggregate is the per-task
  combine, one shuffle of pre-aggregated rows.
* ``word_count_salted``: a heavy-hitter sketch finds the hot words; a salt spreads each of them over
  ``K`` groups, count per ``(salt, word)``, then sum per word. The salt is a hash of the token's line,
  not a random draw, so a retried task re-emits the same keys.
* ``word_count_partitioned``: a combiner in each task counts its physical partition's words, then the
  counts are summed per word.

Per-document term frequency (``doc_term_frequency``) is computed inside each row, since a
document is one row: no shuffle at all.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispersa.functions.text import split_lines, split_words, utf16_length
from dispersa.sources.text import text_lines


def lines(docs: DataFrame, text_col: str = "text", key_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*key_cols, line_no, line)`` — the reference's documents."""
    return text_lines(docs, text_col, key_cols)


def tokens(line_rows: DataFrame, line_col: str = "line") -> DataFrame:
    """One row per token, with the line's other columns kept: ``(..., word)``."""
    keep = [c for c in line_rows.columns if c != line_col]
    return line_rows.select(*keep, F.explode(split_words(line_col)).alias("word"))


def document_count(line_rows: DataFrame) -> DataFrame:
    return line_rows.agg(F.count(F.lit(1)).alias("n"))


def blob_line_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(n)``: the number of documents (lines) in text blobs, from the size of each blob's
    line array — no row per line is generated."""
    return docs.agg(F.coalesce(F.sum(F.size(split_lines(text_col))), F.lit(0)).cast("bigint").alias("n"))


def line_term_counts(line_rows: DataFrame, line_col: str = "line") -> DataFrame:
    """``(..., word, n)``: each line's own term counts, computed inside the row — no shuffle.

    The line's tokens are sorted, run starts are found, and each run becomes one
    ``(word, run length)`` entry. The sorted array is bound to a column first, so the
    lambdas read it instead of re-sorting per element (Catalyst keeps a projection that is
    referenced several times).
    """
    keep = [c for c in line_rows.columns if c != line_col]
    srt = line_rows.select(*keep, F.sort_array(split_words(line_col)).alias("_s"))
    # sequence(1, 0) counts down, so a line without tokens must not reach it. The case stays inside
    # the expression: a filter would be pushed below the projection and split and sort twice.
    starts = F.filter(F.sequence(F.lit(1), F.size("_s")),
                      lambda i: (i == 1) | (F.element_at("_s", i) != F.element_at("_s", i - 1)))
    runs = srt.select(*keep, "_s", F.when(F.size("_s") > 0, starts).otherwise(F.array().cast("array<int>")).alias("_st"))
    ends = F.when(F.size("_s") > 0, F.concat(F.slice("_st", 2, F.size("_st")), F.array(F.size("_s") + 1))
                  ).otherwise(F.array().cast("array<int>"))
    entries = F.zip_with(
        "_st", ends,
        lambda a, b: F.struct(F.element_at("_s", a).alias("word"), (b - a).cast("bigint").alias("n")),
    )
    return runs.select(*keep, F.explode(entries).alias("_t")).select(*keep, "_t.word", "_t.n")


def doc_term_frequency(line_rows: DataFrame, doc_cols: tuple[str, ...] = ("doc_id", "line_no")) -> DataFrame:
    """``(*doc_cols, word, n)``: occurrences of each word within one document (line).

    A document is one row, so its counts are computed in the row (``line_term_counts``);
    a ``groupBy(doc, word)`` would shuffle about one row per distinct word per line only to
    regroup what one task already holds.
    """
    return line_term_counts(line_rows.select(*doc_cols, "line"))


def word_count(line_rows: DataFrame) -> DataFrame:
    return tokens(line_rows).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


HOT_SHARE = 0.01     # a word with this share of all tokens is hot
HOT_TRACKED = 10_000  # words that the sketch follows: an upper bound on its error is tokens / HOT_TRACKED


def hot_words(line_rows: DataFrame, share: float = HOT_SHARE) -> list[str]:
    """Words that hold at least ``share`` of all tokens, by a heavy-hitter sketch in one pass (``approx_top_k``,
    at most ``1 / share`` words). The sketch counts within ``tokens / HOT_TRACKED``, so a word near the border
    may be missed or added; only the plan depends on the list, no count does."""
    top = max(1, min(int(1 / share), HOT_TRACKED))
    row = tokens(line_rows).agg(
        F.expr(f"approx_top_k(word, {top}, {HOT_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [e["item"] for e in row["top"] or [] if e["count"] >= share * row["n"]]


def word_count_salted(
    line_rows: DataFrame, K: int, seed: int = 0, doc_cols: tuple[str, ...] = ("doc_id", "line_no"),
    hot: list[str] | None = None,
) -> DataFrame:
    """Two rounds: ``(salt, word)`` counts, then per word; only hot words (``hot_words``, or as given) get a salt
    of ``K`` values, all others the salt 0. So the first shuffle carries a plain count's rows and at most ``K`` for
    each hot word and task. The map-side partial aggregate gives the reference's per-document combine, so
    tokens feed round 1 directly."""
    if K < 1:
        raise ValueError("K must be >= 1")
    hot = hot_words(line_rows) if hot is None else hot
    deal = F.pmod(F.xxhash64(*[F.col(c) for c in doc_cols], F.lit(int(seed))), F.lit(int(K)))
    salt = F.when(F.col("word").isin(hot), deal).otherwise(F.lit(0)) if hot else F.lit(0)
    return (
        tokens(line_rows)
        .withColumn("salt", salt.cast("bigint"))
        .groupBy("salt", "word")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


COMBINE_WORDS = 1 << 16   # distinct words that a task combines before it hands them on


def partition_word_counts(line_rows: DataFrame, line_col: str = "line") -> DataFrame:
    """``(part, word, n)``: words counted inside each physical partition by one combiner of the task, which holds
    at most ``COMBINE_WORDS`` words and hands its counts on when it is full (so a word may have several rows)."""
    from pyspark import TaskContext

    words = line_rows.select(split_words(line_col).alias("w"))

    def run(batches):
        part = TaskContext.get().partitionId()
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(counts), pa.int32()), pa.array(list(counts), pa.string()),
                 pa.array(list(counts.values()), pa.int64())], names=["part", "word", "n"])

        for batch in batches:
            found = batch.column(0).flatten().value_counts()
            for word, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
                counts[word] += n
            if len(counts) >= COMBINE_WORDS:
                yield out()
                counts.clear()
        if counts:
            yield out()

    return words.mapInArrow(run, "part int, word string, n bigint")


def word_count_partitioned(line_rows: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Combine per physical partition, then sum per word: by default the input's partitions are the reference's
    partitions, so text is never shuffled, only the partitions' counts are. ``num_partitions`` first spreads the
    lines round-robin (the reference's ``repartition(K)``)."""
    src = line_rows.repartition(int(num_partitions)) if num_partitions else line_rows
    return partition_word_counts(src).groupBy("word").agg(F.sum("n").alias("n"))


def distinct_word_count(line_rows: DataFrame) -> DataFrame:
    return tokens(line_rows).agg(F.count_distinct("word").alias("n"))


def average_word_length(word_counts: DataFrame) -> DataFrame:
    """``(avg_len BIGINT)``: total length of the *distinct* words, integer-divided by their
    number (the reference's formula). Length is in UTF-16 units like Java's
    ``String.length()``; sums are 64-bit, so no overflow."""
    return word_counts.agg(
        F.sum(utf16_length("word").cast("bigint")).alias("len_sum"), F.count(F.lit(1)).alias("n_words")
    ).select(F.expr("len_sum div n_words").alias("avg_len"))
