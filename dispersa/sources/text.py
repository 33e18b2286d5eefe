"""Text sources: line records, ``"<id> <class>"`` objects and ``"x,y,..."`` points.

Everything here is a DataFrame transform, so the same code parses a ``spark.read.text``
scan of files, a text column of a Parquet table, or a streaming source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispersa.functions.text import LINE_BREAK_PATTERN, WORD_SEPARATOR, drop_final_empty, split_words

# Fixed value: coordinates of a point line are separated by one comma.
COORD_SEPARATOR = ","


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of the file(s) at ``path`` (a file, directory or glob): ``value STRING``."""
    return spark.read.text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Free text, one document per line (the reference's word-count input): ``(line_no, line)``.

    ``line_no`` is ``monotonically_increasing_id()``: unique and increasing in file order,
    not dense.
    """
    return read_lines(spark, path).select(
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line")
    )


def text_lines(docs: DataFrame, text_col: str = "text", key_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Explode text blobs into ``(*key_cols, line_no INT, line STRING)``; ``line_no`` counts from 0.

    Each blob is read like a text file: ``\\r\\n``, ``\\r`` and ``\\n`` end lines, one final
    line break does not start another line, and an empty blob has no lines.
    """
    # The raw split is projected once; the generator then only trims it (a generator
    # expression does not share common subexpressions, so inlining would split 3 times).
    raw = docs.select(
        *[F.col(c) for c in key_cols], F.col(text_col).alias("_text"),
        F.split(F.col(text_col), LINE_BREAK_PATTERN, -1).alias("_parts"),
    )
    return raw.select(
        *[F.col(c) for c in key_cols],
        F.posexplode(drop_final_empty(F.col("_parts"), F.col("_text"))).alias("line_no", "line"),
    )


def format_object_lines(df: DataFrame, id_col: str, class_col: str) -> DataFrame:
    """Render ``(id, class)`` rows as ``"<id> <class>"`` lines (``value STRING``)."""
    return df.select(F.concat_ws(WORD_SEPARATOR, F.col(id_col).cast("string"), F.col(class_col)).alias("value"))


def parse_object_class(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``"<id> <class>"`` → ``(obj_id BIGINT, class STRING)``; tokens after the second are ignored.

    A non-numeric id or a missing class fails the job (ANSI cast / index errors), as the
    reference's ``Long.parseLong`` and ``tokens[1]`` do. Spark's cast accepts blanks around
    the digits where Java's does not.
    """
    tokens = split_words(value_col)
    return lines.select(
        tokens.getItem(0).cast("bigint").alias("obj_id"),
        F.element_at(tokens, 2).alias("class"),
    )


def format_point_lines(df: DataFrame, id_col: str, coord_cols: list[str]) -> DataFrame:
    """Render ``(id, x, y, ...)`` rows as ``(id, value)`` with ``value = "x,y,..."``."""
    return df.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.concat_ws(COORD_SEPARATOR, *[F.col(c).cast("double").cast("string") for c in coord_cols]).alias("value"),
    )


def parse_points(lines: DataFrame, value_col: str = "value", id_col: str | None = "id") -> DataFrame:
    """``"x,y,..."`` → ``(id BIGINT, p ARRAY<DOUBLE>)``.

    Trailing commas are dropped (Java's split drops trailing empty tokens); any other
    empty or non-numeric token fails the job. Without an id column, ids are assigned
    with ``monotonically_increasing_id`` (unique, not dense).
    """
    value = F.regexp_replace(F.col(value_col), COORD_SEPARATOR + "+$", "")
    p = F.split(value, COORD_SEPARATOR, -1).cast("array<double>").alias("p")
    ident: Column = F.col(id_col).cast("bigint") if id_col else F.monotonically_increasing_id()
    return lines.select(ident.alias("id"), p)
