"""Property checks of the line splitter and the Java-style tokenizer against plain-Python
models, on generated strings (one Spark job for the whole batch)."""

from __future__ import annotations

import re

from hypothesis import given, settings, strategies as st

from dispersa.functions.text import split_lines, split_words

ALPHABET = st.sampled_from(["a", "b", "é", "😀", " ", " ", "\t", "\n", "\r", "\r\n"])


def java_split_space(s: str) -> list[str]:
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def text_file_lines(s: str | None) -> list[str]:
    if not s:
        return []
    parts = re.split(r"\r\n|\r|\n", s)
    if parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=150, max_size=150))
def test_splitters_match_models(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", split_lines("t").alias("lines"), split_words("t").alias("words")).collect()
    for r in rows:
        t = texts[r["i"]]
        assert list(r["lines"]) == text_file_lines(t), repr(t)
        assert list(r["words"]) == java_split_space(t), repr(t)
