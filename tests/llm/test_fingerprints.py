from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from dispersa.llm import jaccard_groups as J
from dispersa.llm import quality_rules as Q
from dispersa.llm import suffix_dedup as D
from dispersa.llm import text as T
from tests.llm import cases


def thue_morse(n, swap=False):
    """The sequence on which polynomial sums modulo a power of two agree with those of its complement."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b ^ swap] for b in bits)


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_thue_morse_strings_have_names_of_their_own(n):
    data = np.frombuffer((thue_morse(n) + thue_morse(n, True) + thue_morse(n)).encode(), np.uint8)
    prints = T.Fingerprints(data)
    at = np.array([0, n, 2 * n])
    a, b, c = prints.of(at, at + n)
    assert a == c != b
    every = prints.every(n)
    assert every[0] == every[2 * n] != every[n]


def test_names_do_not_depend_on_the_place_or_length_of_the_slice():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 300_000, dtype=np.uint8)  # beyond the kept tables
    data[-5000:] = data[:5000]
    prints, short = T.Fingerprints(data), T.Fingerprints(data[:5000])
    start, size = rng.integers(0, 4000, 200), rng.integers(0, 1000, 200)
    want = short.of(start, start + size)
    assert (prints.of(start, start + size) == want).all()
    assert (prints.of(start + 295_000, start + 295_000 + size) == want).all()


def test_operators_tell_thue_morse_texts_apart(spark):
    one, two = thue_morse(1024), thue_morse(1024, True)
    docs = cases.frame(spark, [(1, f"{one}\n{two}"), (2, one), (3, two)])
    judged = {r.doc_id: r.n_dup_lines for r in Q.judge_lines(docs).collect()}
    assert judged[1] == 0
    classes = {r.doc_id: r.component_id for r in J.near_duplicates(docs).collect()}
    assert classes == {1: 1, 2: 2, 3: 3}
    rows = [(1, one), (2, two)]
    got = D.repeat_report(cases.frame(spark, rows), length=1000).collect()
    want = cases.repeats([t for _, t in rows], 1000)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == [
        (i, *w) for (i, _), w in zip(rows, want)]


def test_anchors_of_slices_hold_little_at_once():
    """Arrays of a slice stay small, so they come from a core's cache and not from new pages."""
    rng = np.random.default_rng(2)
    texts = pa.array(["".join(rng.choice(list("abc de"), 2000)) for _ in range(300)])
    shape = D.shape(400)
    next(D.anchors(T.Fingerprints(p.data), p.bounds, shape) for p in T.slices(texts))  # the powers are kept
    tracemalloc.start()
    for part in T.slices(texts):
        D.anchors(T.Fingerprints(part.data), part.bounds, shape)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20


@pytest.mark.parametrize("length", [1, 2, 7, 60])
def test_anchors_hold_every_start_once(length):
    rng = np.random.default_rng(length)
    texts = ["".join(rng.choice(list("ab"), k)) for k in rng.integers(0, 150, 60)] + ["", "a" * 200]
    part = next(T.slices(pa.array(texts)))
    rows, anchor, lo, hi = D.anchors(T.Fingerprints(part.data), part.bounds, D.shape(length))
    got = [(r, p) for r, a, x, y in zip(rows.tolist(), anchor.tolist(), lo.tolist(), hi.tolist()) for p in range(a - y, a - x + 1)]
    bounds = part.bounds.tolist()
    assert got == [(r, p) for r, t in enumerate(texts) for p in range(bounds[r], bounds[r] + len(t) - length + 1)]
