from __future__ import annotations

import hashlib
import random
import re

from dispersa.llm import decontamination as D
from tests.llm import cases


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(cases.LOWER))


def brute(text, items, window=10):
    w = item_words(text)
    hit, found = [0] * len(w), set()
    for name, item in items:
        v = item_words(item)
        n = min(window, len(v))
        for s in {tuple(v[i: i + n]) for i in range(len(v) - n + 1)} if v else ():
            for i in range(len(w) - n + 1):
                if tuple(w[i: i + n]) == s:
                    hit[i: i + n] = [1] * n
                    found.add(str(name))
    names = ",".join(sorted(found))
    return len(w), sum(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), sum(hit) > 0


def made(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(14)]
    items += [(100, items[0][1]), (101, None), (102, "..."), (103, items[5][1].upper() + "!")]
    docs = []
    for i in range(60):
        w = [rng.choice(vocabulary + ["out"]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(w))
            w[at:at] = (rng.choice(items)[1] or "").split()
        docs.append((i, ", ".join(w)))
    return docs + cases.awkward()[:5], items


def report(spark, docs, items, **kw):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return D.match_report(cases.frame(spark, docs), bench, **kw)


def test_matches_brute_force(spark):
    docs, items = made()
    want = cases.Counter((i, *brute(t, items)) for i, t in docs)
    assert cases.rows_of(report(spark, docs, items)) == want


def test_many_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = made(4)
    whole = cases.rows_of(report(spark, docs, items))
    monkeypatch.setattr(D, "BLOCK_WORDS", 20)
    assert cases.rows_of(report(spark, docs, items)) == whole


def test_no_items_and_no_documents(spark):
    got = report(spark, cases.awkward(), []).collect()
    assert len(got) == len(cases.awkward()) and all(r.n_hit == 0 and not r.contaminated for r in got)
    assert report(spark, [], [(1, "a b")]).count() == 0


def test_spans_are_cut_and_covered_documents_go(spark):
    item = " ".join(f"q{i}" for i in range(12))
    rows = [(1, f"Before it. {item.upper()}! After these words there are many others, more than it has itself."),
            (2, item), (3, "clean text stays as it is"), (4, None)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = D.decontaminate(cases.frame(spark, rows), bench)
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == {1, 3, 4} and got[4].text is None
    assert got[1].text == "Before it. ! After these words there are many others, more than it has itself."
    assert got[3].text == rows[2][1] and got[3]._hits == "h" and out.columns == cases.empty(spark).columns
