"""Column expressions for line and word handling with the reference's Java semantics.

All of these are built-in Spark SQL expressions (JVM side, whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's behaviour):
#   line breaks recognised by Hadoop's text reader: "\r\n", "\r", "\n"
#   word separator: one literal space " "
LINE_BREAK_PATTERN = "\r\n|\r|\n"
WORD_SEPARATOR = " "


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_lines(text: Column | str) -> Column:
    """Split a text blob into lines the way a text-file reader does.

    ``""`` and NULL give no line; one final line break does not start an extra line;
    ``"\\n"`` is one empty line.
    """
    return drop_final_empty(F.split(_c(text), LINE_BREAK_PATTERN, -1), _c(text))


def drop_final_empty(parts: Column, text: Column) -> Column:
    """Lines from the raw ``split`` of ``text``: drop the empty piece after a final break."""
    n = F.size(parts)
    trimmed = F.when(F.element_at(parts, -1) == F.lit(""), F.slice(parts, 1, n - 1)).otherwise(parts)
    return F.when(text.isNull() | (text == F.lit("")), F.array().cast("array<string>")).otherwise(trimmed)


def split_words(line: Column | str) -> Column:
    """Java ``String.split(" ")``: leading and inner empty tokens kept, trailing ones dropped.

    ``""`` gives one empty token; a line of only spaces gives no token.
    """
    s = _c(line)
    stripped = F.rtrim(s, F.lit(WORD_SEPARATOR))
    return F.when(
        (s != F.lit("")) & (stripped == F.lit("")), F.array().cast("array<string>")
    ).otherwise(F.split(stripped, WORD_SEPARATOR, -1))


def utf16_length(s: Column | str) -> Column:
    """Java ``String.length()``: the number of UTF-16 code units (a supplementary character
    counts twice), i.e. the UTF-16 byte length divided by two — no regular expression."""
    return (F.octet_length(F.encode(_c(s), "UTF-16BE")) / 2).cast("int")
