from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from dispersa.llm import jaccard_groups as J
from tests.llm import cases


def made(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out, passages = [], [" ".join(rng.choice(vocabulary) for _ in range(50)) for _ in range(3)]
    for copies in (2, 3, 8, 30):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            out.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
    for _ in range(30):
        out.append(rng.choice(passages) + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 30))))
    return out + [" ".join(rng.choice(passages) for _ in range(3)) for _ in range(20)]


def report(spark, rows):
    return cases.rows_of(J.near_duplicates(cases.frame(spark, rows).repartition(3)))


def expected(rows):
    return Counter((i, *x) for (i, _), x in zip(rows, cases.components([i for i, _ in rows], [t for _, t in rows])))


@pytest.mark.parametrize("sizes", [None, (2, 3, 2)])
def test_matches_brute_force(spark, monkeypatch, sizes):
    if sizes:  # many frequent tokens, small groups, many deals
        for name, value in zip(("HOT", "GROUP", "ASKERS"), sizes):
            monkeypatch.setattr(J, name, value)
    texts = made(5)
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    rows = list(zip(ids, texts))
    assert report(spark, rows) == expected(rows)


def test_awkward_rows_and_empty_table(spark):
    assert report(spark, cases.awkward()) == expected(cases.awkward())
    assert J.near_duplicates(cases.empty(spark)).count() == 0


def test_threshold_is_exact(spark):
    base = [f"t{i}" for i in range(103)]  # 100 shingles
    near = base[:92] + ["x"] * 11  # 89 of its shingles are base's
    far = base[:95] + [f"y{i}" for i in range(8)]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))]
    assert report(spark, rows) == expected(rows)


def test_keep_one(spark):
    out = J.keep_one(cases.frame(spark, [(5, "a b c d e"), (3, "A b c d e"), (3, "A b c d e"), (4, "other words in here"),
                                         (7, None), (None, "a b c d e")]))
    assert out.columns == cases.empty(spark).columns
    assert Counter(r.doc_id for r in out.collect()) == Counter([3, 3, 4, 7, None])


def test_picked_text_of_a_class_survives_shared_bits(spark, monkeypatch):
    monkeypatch.setattr(J, "HOT_BITS", 5)  # every text passes the bitmap
    base = [f"alpha{k} beta{k} gamma{k} delta{k} epsilon{k}" for k in range(60)]
    rows = [(i, f(t)) for i, (t, f) in enumerate((t, f) for t in base for f in (str.upper, str.title, str))]
    docs = cases.frame(spark, rows).select("doc_id", "text").coalesce(1)
    placed = J.classes(docs, "doc_id", "text", J.Join())
    got = J.class_texts(docs, "text", J.Join(), placed, placed.select("c").distinct()).collect()
    assert sorted(r.text.lower() for r in got) == sorted(base)


def test_keep_one_keeps_other_texts_of_an_id(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "quite another text stands here")]
    out = J.keep_one(cases.frame(spark, rows))
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [rows[0], rows[2]]


def test_sets_are_sorted_row_by_row(monkeypatch):
    """No order over all tokens of a slice is made."""
    rng = np.random.default_rng(3)
    texts = pa.array([None, "", "one two"] + [" ".join(rng.choice(list("abcd"), k)) for k in rng.integers(1, 80, 50)])
    monkeypatch.setattr(J.np, "lexsort", None)
    part = next(J.T.slices(texts))
    s = J.sets_of(part, J.Join())
    ordered = J._ordered(s, np.zeros(1 << (J.HOT_BITS - 5), np.uint32))
    for r, t in enumerate(texts.to_pylist()):
        words = (t or "").split()
        tokens = s.tokens[s.before[r]: s.before[r + 1]]
        assert len(tokens) == len({tuple(words[i: i + 4]) for i in range(max(1, len(words) - 3))} if words else ())
        assert (np.diff(tokens.astype(object)) > 0).all()
        assert (ordered[s.before[r]: s.before[r + 1]] == np.sort(tokens >> np.uint64(1))).all()
