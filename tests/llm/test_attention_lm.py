from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from dispersa.llm import attention_lm as A
from dispersa.llm.queries import vocabulary
from tests.llm import cases

PATH = vocabulary("byte_bpe_50k.tiktoken")


def test_gradient_matches_differences():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, 3000)
    voc = A.Vocabulary.build(counts, rng.random(3000) < 0.5)
    flat = A.initial().astype(np.float64)
    pairs = rng.normal(size=(A.ROWS, A.CLASSES))
    rows = voc.row[rng.integers(0, 3000, (4, A.WINDOW))]
    rows[0, :5] = A.PAD
    target, known = rng.integers(0, A.CLASSES, (4, A.HALF)), rng.random((4, A.HALF)) < 0.8
    _, grad = A.step(A._unpack(flat), pairs, rows, target, known)
    for i in [*np.flatnonzero(grad)[::997], len(flat) - 5, len(flat) - 100]:
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-4
        down[i] -= 1e-4
        slope = (A.step(A._unpack(up), pairs, rows, target, known)[0] - A.step(A._unpack(down), pairs, rows, target, known)[0]) / 2e-4
        assert abs(slope - grad[i]) < 1e-4 + 1e-3 * abs(slope)


def test_scores_match_one_window_at_a_time():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, 2000)
    voc = A.Vocabulary.build(counts, rng.random(2000) < 0.5)
    w = A._unpack(A.initial().astype(np.float64))
    pairs, within = rng.normal(size=(A.ROWS, A.CLASSES)), rng.normal(size=(A.ROWS, A.ROWS))
    sizes = [1, 2, A.HALF, A.WINDOW + 3, 70]
    docs = [np.append(rng.integers(0, 1999, n - 1), 1999) for n in sizes]
    got = A.Scorer(np.concatenate([w[n].ravel() for n in A.SHAPES]), pairs, within, voc).logs(
        np.concatenate(docs), np.concatenate([[0], np.cumsum(sizes)]))
    want = []
    for d in docs:
        inputs = np.append(voc.row[1999], voc.row[d[:-1]])
        for t in range(len(d)):
            lo = max(0, t // A.HALF * A.HALF - A.HALF)
            x = w["x"][inputs[lo: t + 1]]
            s = (x @ w["wk"]) @ (x[-1] @ w["wq"]) / math.sqrt(A.KEY) + w["far"][np.arange(t - lo, -1, -1)]
            a = np.exp(s - s.max())
            h = np.tanh((a / a.sum()) @ (x @ w["wv"]) + x[-1])
            z = h @ w["wo"] + w["b"] + pairs[inputs[t]]
            logp = z[voc.of_class[d[t]]] - np.log(np.exp(z).sum())
            logp += within[inputs[t], voc.row[d[t]]]
            want.append((logp + voc.log_share[d[t]]) / np.log(10))
    assert np.allclose(got, want, atol=1e-3)


def test_probabilities_after_any_input_sum_to_one(spark):
    rows = [(n, f"a b c{n} " * n) for n in range(12)]
    sub = A.subwords(PATH)
    coded = A.coded_documents(cases.frame(spark, rows).repartition(3), F.lit(True), PATH, "doc_id", "text")
    counts = np.arange(sub.end + 1) % 7
    voc = A.Vocabulary.build(counts, sub.starts_word)
    pairs, within = A.pair_tables(coded, voc, counts)
    assert np.allclose(np.exp(pairs).sum(axis=1), 1, atol=1e-4)
    for before in (0, 5, A.OWN + 3, int(voc.row[sub.end])):
        p = np.exp(pairs[before][voc.of_class] + within[before][voc.row] + voc.log_share)
        assert math.isclose(p.sum(), 1, rel_tol=1e-3)


def test_every_training_id_is_a_target_once(spark, monkeypatch):
    """Targets of all rounds against the ids of all documents, each with the ids before it."""
    rows = cases.awkward() + [(20 + n, "word " * n) for n in range(30)]
    coded = A.coded_documents(cases.frame(spark, rows), F.lit(True), PATH, "doc_id", "text")
    lists = [np.frombuffer(r.ids, "<u2").tolist() for r in coded.collect()]
    end = A.subwords(PATH).end
    monkeypatch.setattr(A, "SHARD_IDS", 200)
    deal, shards = A.dealt(coded, end, A.ROUNDS)
    placed = deal.collect()
    assert len(placed) == len(lists) and shards > 2
    assert {(r.round, r.shard) for r in placed} <= {(n, k) for n in range(A.ROUNDS) for k in range(shards)}
    got = Counter()
    for number in range(A.ROUNDS):
        mine = [np.frombuffer(r.ids, "<u2").tolist() for r in placed if r.round == number]
        for part in A.windows(np.concatenate(mine), np.concatenate([[0], np.cumsum([len(x) for x in mine])]), end, number):
            assert part.shape[1] == A.WINDOW + 1 and len(part) <= A.BATCH
            got.update(map(tuple, part.tolist()))
    want = Counter()
    for ids in lists:
        padded = [-1] * A.HALF + [end] + ids + [-1] * A.HALF
        want.update(tuple(padded[t: t + A.WINDOW + 1]) for t in range(0, len(ids), A.HALF))
    assert got == want
    assert sum(x >= 0 for w, n in got.items() for _ in range(n) for x in w[A.HALF + 1:]) == sum(map(len, lists))
    text = dict(rows)[9]
    assert any(np.array_equal(x, A.code(next(A.T.slices(A.pa.array([text]))), A.subwords(PATH)).ids) for x in lists)


def base(rows, learn):
    tokens = lambda t: [w for w in cases.words((t or "").translate(cases.LOWER))] + [None]
    c = Counter(w for i, t in rows if learn(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    whole = math.log10(n + 0.1 * (v + 1))
    return [(i, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10(c[w] + 0.1) - whole for w in tokens(t)))
            for i, t in rows]


def check(spark, rows, learn, condition):
    got = A.score_documents(cases.frame(spark, rows), PATH, condition).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    mine = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for a, b in zip(mine, sorted(base(rows, learn), key=key), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-6)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got if r.train_tokens)


def test_base_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(A, "TOP_WORDS", 5)  # most words take the way of the join
    check(spark, cases.awkward(), lambda i: i is not None and i % 2 == 0, F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False)))


def test_no_training_documents_and_empty_table(spark):
    check(spark, cases.awkward(), lambda i: False, F.lit(False))
    assert A.score_documents(cases.empty(spark), PATH, F.lit(True)).count() == 0


def test_learned_text_is_likelier_than_random_words(spark):
    rows = [(i, "the cat sat on the mat and the dog ran after the cat . " * 6) for i in range(30)]
    rows += [(100, "the cat sat on the mat"), (101, "zq vv jjx kw pqz xx")]
    got = {r.doc_id: r for r in A.score_documents(cases.frame(spark, rows), PATH, F.col("doc_id") < 100).collect()}
    assert got[100].score > got[101].score
    assert got[100].score > got[101].base_score


def test_weights_follow_from_the_documents_alone(spark, monkeypatch):
    monkeypatch.setattr(A, "SHARD_IDS", 300)
    monkeypatch.setattr(A, "SUM_SHARDS", 2)
    rows = cases.awkward()[:8] + [(20 + n, f"word{n % 5} and more {n} " * (n % 9)) for n in range(60)]
    scores = []
    for parts in (1, 7):
        docs = cases.frame(spark, rows).repartition(parts)
        got = A.score_documents(docs, PATH, F.coalesce(F.col("doc_id") % 3 > 0, F.lit(False))).collect()
        scores.append(sorted((str(r.doc_id), r.n_tokens, r.score) for r in got))
    assert scores[0] == scores[1]


def test_pair_tables_match_counts(spark):
    rows = [(n, f"a b c{n} " * n) for n in range(12)]
    sub = A.subwords(PATH)
    coded = A.coded_documents(cases.frame(spark, rows).repartition(3), F.lit(True), PATH, "doc_id", "text")
    counts = np.arange(sub.end + 1) % 7
    voc = A.Vocabulary.build(counts, sub.starts_word)
    pairs, within = A.pair_tables(coded, voc, counts)
    seen, of_class = Counter(), Counter()
    for r in coded.collect():
        ids = np.frombuffer(r.ids, "<u2").tolist()
        for before, i in zip([sub.end, *ids], ids):
            seen[voc.row[before], voc.row[i]] += 1
            of_class[voc.row[before], voc.of_class[i]] += 1
    mass = np.bincount(voc.row, weights=counts + A.SMOOTH, minlength=A.ROWS)
    whole = np.bincount(voc.of_class, weights=counts + A.SMOOTH, minlength=A.CLASSES)
    all_classes = Counter()
    for (_, c), n in of_class.items():
        all_classes[c] += n
    total = sum(all_classes.values()) + A.SMOOTH * A.CLASSES
    for (before, row), n in seen.items():
        c = voc.of_class[np.flatnonzero(voc.row == row)[0]]
        want = (n + A.LEAN * mass[row] / whole[c]) / (of_class[before, c] + A.LEAN)
        assert math.isclose(math.exp(within[before, row]), want, rel_tol=1e-4)
        inputs = sum(k for (b, _), k in of_class.items() if b == before)
        want = (of_class[before, c] + A.LEAN * (all_classes[c] + A.SMOOTH) / total) / (inputs + A.LEAN)
        assert math.isclose(math.exp(pairs[before, c]), want, rel_tol=1e-4)


def test_copies_are_dealt_over_rounds_and_shards(spark, monkeypatch):
    monkeypatch.setattr(A, "SHARD_IDS", 500)
    coded = A.coded_documents(cases.frame(spark, [(n, "one text of many copies") for n in range(800)]), F.lit(True), PATH, "doc_id", "text")
    deal, shards = A.dealt(coded, A.subwords(PATH).end, A.ROUNDS)
    loads = [r["count"] for r in deal.groupBy("round", "shard").count().collect()]
    assert shards > 3 and len(loads) == shards * A.ROUNDS and max(loads) < 3 * 800 / len(loads)


ODD = ["it's", "'s", "a\u0085", " b", "c　d", " ", "x\x1cy", "É日本", "a1b2", "--'ll", "\u0085", "𝒳​", "café's"]


def test_words_have_the_ids_that_they_have_alone(spark, monkeypatch):
    monkeypatch.setattr(A, "CACHED_WORDS", 6)  # what is known is dropped again and again
    sub = A.Subwords(PATH)
    rows = [" ".join(ODD), None, "it's it's a1b2", "plain words only", " ".join(reversed(ODD)), "", "\n".join(["plain", "it's"])]
    for texts in (rows, rows[3:], rows[:1], rows):
        got = A.code(next(A.T.slices(A.pa.array(texts, A.pa.string()))), sub)
        alone = [[sub.bpe.encode_ordinary(" " + w) for w in cases.words((t or "").translate(cases.LOWER))] for t in texts]
        want = [[i for w in doc for i in w] + [sub.end] for doc in alone]
        assert [got.ids[a:b].tolist() for a, b in zip(got.bounds, got.bounds[1:])] == want
        # Each word's ids begin with one that begins with a space, and no other does.
        assert all(sub.starts_word[w[0]] and not sub.starts_word[w[1:]].any() for doc in alone for w in doc)


def test_base_of_words_next_to_odd_white_space(spark, monkeypatch):
    monkeypatch.setattr(A, "TOP_WORDS", 4)
    rows = [(n, " ".join(ODD[: n % len(ODD) + 1] + ["and"] * n)) for n in range(30)]
    check(spark, rows, lambda i: i % 3 > 0, F.col("doc_id") % 3 > 0)


def test_counts_of_words_and_ids_come_with_the_encoding(spark, monkeypatch):
    monkeypatch.setattr(A, "COUNTED_WORDS", 7)
    monkeypatch.setattr(A, "COUNTS_A_ROW", 3)
    rows = [(n, f"a b c{n % 4} " * (n % 7)) for n in range(40)]
    coded, words, ids = A.coded_and_counted(cases.frame(spark, rows).repartition(3), F.col("doc_id") % 2 == 0, PATH, "doc_id", "text")
    assert coded.columns == ["id", "learn", "ids", "mark"] and coded.count() == len(rows)  # texts are not kept
    of_words = Counter(w for n, t in rows if n % 2 == 0 for w in t.split())
    assert Counter(r.c for r in words.collect()) == Counter(of_words.values())
    end = A.subwords(PATH).end
    of_ids = Counter(i for r in coded.filter("learn").collect() for i in np.frombuffer(r.ids, "<u2").tolist())
    got = A.id_counts(ids, end)
    assert {i: n for i, n in enumerate(got.tolist()) if n} == of_ids and got[end] == 20


def test_steps_use_their_large_arrays_again():
    rng = np.random.default_rng(4)
    voc = A.Vocabulary.build(rng.integers(0, 50, 3000), rng.random(3000) < 0.5)
    w, pairs, room = A._unpack(A.initial()), rng.normal(size=(A.ROWS, A.CLASSES)).astype(np.float32), A.Room()
    found = []
    for size in (A.BATCH, 37, A.BATCH):
        rows = voc.row[rng.integers(0, 3000, (size, A.WINDOW))]
        target, known = rng.integers(0, A.CLASSES, (size, A.HALF)), rng.random((size, A.HALF)) < 0.9
        found.append((A.step(w, pairs, rows, target, known, room), A.step(w, pairs, rows, target, known)))
        held = {k: id(v) for k, v in room.held.items()} if size == A.BATCH and len(found) == 1 else held
        assert {k: id(v) for k, v in room.held.items()} == held
    assert all(a[0] == b[0] and np.array_equal(a[1], b[1]) for a, b in found)


def test_scores_do_not_follow_the_documents_beside(spark):
    rng = np.random.default_rng(5)
    voc = A.Vocabulary.build(rng.integers(0, 50, 2000), rng.random(2000) < 0.5)
    pairs, within = (rng.normal(size=s).astype(np.float32) for s in ((A.ROWS, A.CLASSES), (A.ROWS, A.ROWS)))
    scorer = A.Scorer(A.initial(), pairs, within, voc)
    docs = [np.append(rng.integers(0, 1999, n - 1), 1999) for n in [1, 9, 8, A.BLOCKS * A.HALF + 5, 3, 70]]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    together = scorer.logs(np.concatenate(docs), bounds)
    for d, lo, hi in zip(docs, bounds, bounds[1:]):
        assert np.array_equal(scorer.logs(d, np.array([0, len(d)])), together[lo:hi])
