from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa

from dispersa.llm import line_crf as L
from dispersa.llm import text as T
from tests.llm import cases


def test_marginals_match_all_labellings():
    rng = np.random.default_rng(1)
    rows = np.array([0, 0, 0, 1, 2, 2, 2, 2])
    unary, ties = rng.normal(size=8), rng.normal(size=(2, 2))
    got, pairs = L._Chains(rows).marginals(unary, ties)
    want, want_pairs = np.zeros(8), np.zeros((2, 2))
    for doc in np.unique(rows):
        at = np.flatnonzero(rows == doc)
        weights = {}
        for y in itertools.product((0, 1), repeat=len(at)):
            weights[y] = np.exp(sum(unary[i] * v for i, v in zip(at, y)) + sum(ties[a, b] for a, b in zip(y, y[1:])))
        total = sum(weights.values())
        for y, x in weights.items():
            for i, v in zip(at, y):
                want[i] += v * x / total
            for a, b in zip(y, y[1:]):
                want_pairs[a, b] += x / total
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = ["river", "stone", "house", "walked", "under", "light", "evening", "garden", "letter", "winter"]
    out = []
    for i in range(n):
        if i % 2:
            out.append("\n".join(" ".join(rng.choice(vocabulary) for _ in range(12)).capitalize() + "." for _ in range(rng.randint(1, 8))))
        else:
            out.append("\n".join(" | ".join(rng.choice(vocabulary).upper() for _ in range(8)) for _ in range(rng.randint(1, 8))))
    return out


def test_learns_and_scores_held_out_documents(spark):
    docs = cases.frame(spark, list(enumerate(texts(300, 1))))
    labels = spark.createDataFrame([(i, i % 2) for i in range(300) if i % 3 != 1], "doc_id long, quality int")
    model = L.train(docs, labels)
    got = {r.doc_id: r for r in L.score_documents(docs, model).collect()}
    held = [i for i in range(300) if i % 3 == 1]
    assert np.mean([got[i].predicted == i % 2 for i in held]) > 0.95
    again = L.train(docs.repartition(5), labels)
    assert np.allclose(model.weights, again.weights)


def test_awkward_rows(spark):
    docs = cases.frame(spark, cases.awkward() + list(enumerate(texts(40, 2), 100)))
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 140)] + [(100, None), (None, 1), (1, 0)], "doc_id long, quality int")
    model = L.train(docs, labels)
    got = L.score_documents(docs, model).collect()
    assert len(got) == len(cases.awkward()) + 40 and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == model.prior for r in got if r.doc_id in (1, 2, 3))
    assert L.score_documents(cases.empty(spark), model).count() == 0


def test_without_labels_or_with_one_kind(spark):
    docs = cases.frame(spark, cases.awkward())
    none = L.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in L.score_documents(docs, none).collect()} == {0.5}
    one = L.train(docs, spark.createDataFrame([(4, 1), (6, 1)], "doc_id long, quality int"))
    assert {r.score for r in L.score_documents(docs, one).collect()} == {1.0}


def test_long_text_has_one_feature_row_a_line():
    part = next(T.slices(pa.array(["some words here.\n" * 30_000])))
    features, size, rows = L.line_features(part)
    assert features.shape == (30_000, L.FEATURES) and rows.max() == 0 and np.isfinite(features).all()
