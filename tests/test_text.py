"""Line splitting, Java-style tokenising and the two text parsers."""

from __future__ import annotations

import pytest

from dispersa.functions.text import split_words, utf16_length
from dispersa.operators import words
from dispersa.sources import text as text_src


def _java_split_space(s: str) -> list[str]:
    """Plain-Python model of Java's String.split(" ") (limit 0)."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


TOKENS_EDGE = ["", "   ", " a", "a  b", "a ", "a\tb c", "x 😀 y", "solo", "  lead and trail  "]


def test_split_words_matches_java(spark):
    df = spark.createDataFrame([(s,) for s in TOKENS_EDGE], "value string")
    got = {r["value"]: list(r["w"]) for r in df.select("value", split_words("value").alias("w")).collect()}
    for s in TOKENS_EDGE:
        assert got[s] == _java_split_space(s), s


def test_utf16_length_counts_surrogate_pairs(spark):
    df = spark.createDataFrame([("abc",), ("😀",), ("é😀x",), ("",)], "w string")
    got = [r[0] for r in df.select(utf16_length("w")).collect()]
    assert got == [3, 2, 4, 0]


@pytest.mark.parametrize(
    "text,lines",
    [
        ("", []),
        (None, []),
        ("a", ["a"]),
        ("a\n", ["a"]),
        ("\n", [""]),
        ("a\n\nb", ["a", "", "b"]),
        ("a\r\nb\rc\n", ["a", "b", "c"]),
        ("a\n\n", ["a", ""]),
    ],
)
def test_text_lines_like_a_text_file(spark, text, lines):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got = [(r["line_no"], r["line"]) for r in text_src.text_lines(df).orderBy("line_no").collect()]
    assert got == list(enumerate(lines))


def test_word_counts_agree_and_sum_to_tokens(spark):
    docs = spark.createDataFrame(
        [(1, "the cat\nthe dog  the\n\n"), (2, "cat cat\n   \n"), (3, "")], "doc_id bigint, text string"
    )
    lines = words.lines(docs)
    expected = {}
    n_tokens = 0
    for _, t in [(1, "the cat\nthe dog  the\n\n"), (2, "cat cat\n   \n")]:
        for line in t.split("\n")[:-1] if t.endswith("\n") else t.split("\n"):
            for w in _java_split_space(line):
                expected[w] = expected.get(w, 0) + 1
                n_tokens += 1
    for fn in (words.word_count, lambda l: words.word_count_salted(l, 3, 7),
               lambda l: words.word_count_partitioned(l, 2)):
        got = {r["word"]: r["n"] for r in fn(lines).collect()}
        assert got == expected
    assert words.distinct_word_count(lines).first()["n"] == len(expected)
    assert sum(r["n"] for r in words.doc_term_frequency(lines).collect()) == n_tokens
    assert words.document_count(lines).first()["n"] == 5
    avg = words.average_word_length(words.word_count(lines)).first()["avg_len"]
    assert avg == sum(len(w) for w in expected) // len(expected)


def test_parse_object_class(spark):
    lines = spark.createDataFrame([("5 Western",), ("-7 Action extra",)], "value string")
    got = [tuple(r) for r in text_src.parse_object_class(lines).collect()]
    assert got == [(5, "Western"), (-7, "Action")]


@pytest.mark.parametrize("bad", ["5", "x Western", "5 "])
def test_parse_object_class_rejects_bad_lines(spark, bad):
    lines = spark.createDataFrame([(bad,)], "value string")
    with pytest.raises(Exception):
        text_src.parse_object_class(lines).collect()


def test_parse_points(spark):
    lines = spark.createDataFrame([(1, "1.5,2"), (2, "3,4,"), (3, "-1e3,0.25")], "id bigint, value string")
    got = {r["id"]: list(r["p"]) for r in text_src.parse_points(lines).collect()}
    assert got == {1: [1.5, 2.0], 2: [3.0, 4.0], 3: [-1000.0, 0.25]}
    bad = spark.createDataFrame([(1, "1,,2")], "id bigint, value string")
    with pytest.raises(Exception):
        text_src.parse_points(bad).collect()


def test_point_lines_round_trip(spark):
    df = spark.createDataFrame([(1, 7, 901.25), (2, 1, 1000.0)], "k bigint, a int, b double")
    lines = text_src.format_point_lines(df, "k", ["a", "b"])
    got = {r["id"]: list(r["p"]) for r in text_src.parse_points(lines).collect()}
    assert got == {1: [7.0, 901.25], 2: [1.0, 1000.0]}


def test_blob_line_count_matches_exploded_lines(spark):
    docs = spark.createDataFrame([(1, "a\nb\n"), (2, ""), (3, None), (4, "\n"), (5, "x\r\ny")], "doc_id bigint, text string")
    assert words.blob_line_count(docs).first()["n"] == words.document_count(words.lines(docs)).first()["n"] == 5
    empty = docs.where("doc_id < 0")
    assert words.blob_line_count(empty).first()["n"] == 0
