from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from dispersa.llm import suffix_dedup as S
from tests.llm import cases


def made(seed):
    rng = random.Random(seed)
    text = lambda a, b: "".join(rng.choice("abcdefgh é\n") for _ in range(rng.randint(a, b)))
    base, passages = [text(40, 500) for _ in range(25)], [text(60, 200) for _ in range(4)]
    out = list(base)
    for _ in range(25):
        b = rng.choice(base)
        k = rng.randint(0, len(b))
        out.append(b[:k] + rng.choice(["x", "", "yy", rng.choice(passages)]) + b[k:])
    out += [rng.choice(passages) + rng.choice(base)[:50] + rng.choice(passages) for _ in range(15)]
    return out + ["a" * 700, "ab" * 250, None, "", base[0], base[0]]


@pytest.mark.parametrize("length", [1, 3, 40, 100])
def test_matches_brute_force(spark, length):
    texts = made(length)
    rows = list(enumerate(texts)) + [(None, texts[3]), (3, texts[3])]
    want = Counter((i, *x) for (i, _), x in zip(rows, cases.repeats([t for _, t in rows], length)))
    assert cases.rows_of(S.repeat_report(cases.frame(spark, rows), length=length)) == want


def test_awkward_rows_and_empty_table(spark):
    rows = cases.awkward()
    want = Counter((i, *x) for (i, _), x in zip(rows, cases.repeats([t for _, t in rows], 400)))
    assert cases.rows_of(S.repeat_report(cases.frame(spark, rows))) == want
    assert S.repeat_report(cases.empty(spark)).count() == 0
    with pytest.raises(ValueError):
        S.shape(0)


def test_remove_repeats_cuts_the_text_only(spark):
    passage = "".join(chr(97 + i * i % 23) for i in range(450))
    rows = [(1, "before " + passage + " after"), (2, passage), (3, "clean"), (4, None)]
    out = S.remove_repeats(cases.frame(spark, rows))
    assert out.columns == cases.empty(spark).columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "before  after", 2: "", 3: "clean", 4: None}


def without_repeats(texts, length, words):
    """Texts without byte strings of ``length`` and runs of ``words`` words that occur twice, by comparing all."""
    raws = [t.encode() for t in texts]
    seen = Counter(r[p: p + length] for r in raws for p in range(len(r) - length + 1))
    places = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", r)] for r in raws]
    run = lambda r, at, p: tuple(r[a:b] for a, b in at[p: p + words])
    runs = Counter(run(r, at, p) for r, at in zip(raws, places) for p in range(len(at) - words + 1))
    out = []
    for r, at in zip(raws, places):
        cover = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if seen[r[p: p + length]] > 1:
                cover[p: p + length] = b"\1" * length
        hit = set()
        for p in range(len(at) - words + 1):
            if runs[run(r, at, p)] > 1:
                hit.update(range(p, p + words))
        for w in hit:
            a, b = at[w][0], at[w + 1][0] if w + 1 in hit else at[w][1]
            cover[a:b] = b"\1" * (b - a)
        out.append(bytes(b for b, c in zip(r, cover) if not c).decode("utf-8", "replace"))
    return out


def test_runs_of_words_match_brute_force(spark):
    rng = random.Random(8)
    some = lambda n: [rng.choice(["a", "bé", "c,", "dddd", "日本"]) + str(rng.randint(0, 40)) for _ in range(n)]
    join = lambda w: "".join(x + rng.choice([" ", " ", "\n", "  "]) for x in w)
    passages = [some(n) for n in (50, 51, 52, 70, 90)]
    texts = []
    for _ in range(30):
        p, q = rng.choice(passages), rng.choice(passages)
        texts.append(join(some(rng.randint(0, 40)) + p + some(rng.randint(0, 5)) + q[rng.randint(0, 30):]))
    texts += [join(some(60)) for _ in range(5)] + ["x" * 450 + " end", "y " + "x" * 450, ""]
    rows = list(enumerate(dict.fromkeys(texts)))
    got = {r.doc_id: r.text for r in S.remove_repeats(cases.frame(spark, rows), words=51).collect()}
    assert got == dict(enumerate(without_repeats([t for _, t in rows], 400, 51)))


def test_copies_of_short_words_are_repeats(spark):
    short = " ".join("abcdefghij"[i % 10] for i in range(51))  # 101 bytes
    rows = [(1, short), (2, short), (3, short[:-2]), (4, "other " + short)]
    got = {r.doc_id: r.text for r in S.remove_repeats(cases.frame(spark, rows), words=51).collect()}
    assert got == {1: "", 2: "", 3: short[:-2], 4: "other "}


def test_report_with_passages_counts_what_the_removal_cuts(spark):
    rng = random.Random(12)
    word = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 999)) for _ in range(n))
    passage, long = word(51), word(120)
    texts = [f"{word(30)} {passage} {word(5)}", f"{passage} {word(9)}", word(60), word(50), f"{long} {word(3)}", f"{word(4)} {long}",
             word(52), None, ""]
    texts.append(texts[6])  # exact copies of less than 400 bytes
    docs = cases.frame(spark, list(enumerate(texts)))
    got = {r.doc_id: r for r in S.repeat_report(docs, words=51).collect()}
    kept = {r.doc_id: r.text for r in S.remove_repeats(docs, words=51).collect()}
    for (i, t), want in zip(enumerate(texts), cases.repeats(texts, 400)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want
        assert r.passage_bytes == len((t or "").encode()) - len((kept[i] or "").encode()) >= r.n_removed
        assert (r.passage_bytes > 0) == (r.n_passages > 0) == (i in (0, 1, 4, 5, 6, 9))


def test_first_ranks_are_made_once_and_a_hot_rank_is_many_parts(spark):
    """The rows whose rank others have, from one pass over the texts; negative ranks and ranks that differ late too."""
    rng = random.Random(5)
    rows = [(rng.randrange(1 << 60), p, 7 << 40) for p in range(2000)]  # one rank in very many texts
    rows += [(rng.randrange(1 << 60), p, rng.choice([-1, 1]) * (rng.randrange(900) << 20)) for p in range(1500)]
    rows += [(5, p, -(3 + p) << 30) for p in range(40)] + [(9, 1, -1), (9, 2, -1), (11, 3, 77), (27, 4, 77)]
    passes = spark.sparkContext.accumulator(0)

    def made_once(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    first = spark.createDataFrame(rows, "k long, pos int, rank long").mapInArrow(made_once, "k long, pos int, rank long")
    shared = Counter(r for *_, r in rows)
    got = Counter((r.k, r.pos) for r in S._repeated(first).collect())
    assert got == Counter((k, p) for k, p, r in rows if shared[r] > 1)
    assert passes.value == len(rows)
