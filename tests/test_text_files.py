"""The text-file sources end to end: "<id> <class>" lines, "x,y" point lines, free text."""

from __future__ import annotations

import math

from dispersa.operators import counts, diameter, kcenter, words
from dispersa.sources import text as text_src


def test_objects_from_a_text_file(spark, tmp_path):
    path = tmp_path / "objects.txt"
    path.write_text("10 oak\n11 elm\n12 oak\n13 ash\n14 oak\n15 elm\n16 oak")  # no final break
    objs = text_src.parse_object_class(text_src.read_lines(spark, str(path)))
    assert [tuple(r) for r in counts.class_count(objs, 2).collect()] == [("ash", 1), ("elm", 2), ("oak", 4)]
    assert counts.max_partition_size(objs, 2).first()["max_part"] == 4


def test_points_from_a_text_file(spark, tmp_path):
    path = tmp_path / "points.csv"
    rows = [(0.0, 0.0), (3.0, 4.0), (1.0, 1.0), (3.0, 4.0)]
    path.write_text("\n".join(f"{x},{y}," for x, y in rows) + "\n")  # trailing commas, final break
    pts = text_src.parse_points(text_src.read_lines(spark, str(path)), id_col=None)
    got = pts.orderBy("id").collect()
    assert [list(r["p"]) for r in got] == [list(r) for r in rows]  # ids follow file order
    assert diameter.exact_diameter(pts).first()["max_dist"] == 5.0
    first = [r["id"] for r in got][0]
    cen = kcenter.farthest_first(pts, 2).orderBy("ord").collect()
    assert cen[0]["id"] == first and cen[1]["min_dist"] == 5.0
    assert cen[1]["id"] == got[1]["id"]  # tie between the two copies of (3,4): first in file order


def test_words_from_a_text_file(spark, tmp_path):
    path = tmp_path / "docs.txt"
    path.write_text("a b a\n\nc  a\n")
    lines = text_src.read_documents(spark, str(path))
    got = {r["word"]: r["n"] for r in words.word_count(lines).collect()}
    assert got == {"a": 3, "b": 1, "": 2, "c": 1}
    assert words.document_count(lines).first()["n"] == 3
    assert words.average_word_length(words.word_count(lines)).first()["avg_len"] == math.floor(3 / 4)
    tf = {(r["line_no"], r["word"]): r["n"] for r in words.doc_term_frequency(lines, ("line_no",)).collect()}
    assert sorted(tf.values()) == [1, 1, 1, 1, 1, 2]
