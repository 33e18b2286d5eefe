"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is good or bad. Its potentials come from features of the line and of the lines
before and after it; neighbouring labels are tied by transition weights. Training maximises the
conditional likelihood (each line of a labelled document carries the document's label) by Adam steps over
a sample of at most ``SAMPLE_DOCS`` labelled documents, the ones with the smallest id hashes. Scoring runs
forward-backward over all lines of every document; the score is the mean of the lines' marginals of
"good", weighted by the lines' length in bytes.

Only the text is a feature. Defined results: a document without lines (NULL, empty, white space) scores
the share of good documents in the sample; with labels of one kind or none at all every score is that
share (0.5 without labels). Labels that are NULL or have a NULL id are not used; a document labelled
twice counts twice. Repeated rows are scored row by row (equal texts score alike), an empty table gives no
rows, extra columns are ignored, long texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispersa.llm import text as T

SAMPLE_DOCS = 4_000
STEPS = 150
RATE = 0.1
PENALTY = 1e-3
SLICE_BYTES = 1 << 20
FEATURES = 16


def _flag(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _MARK, _DIGIT = _flag(b"#*$%&|<>=~^_{}[]\\/@+"), _flag(b"!?"), _flag(b"0123456789")
_END, _ASCII_UPPER, _ASCII_LOWER = _flag(b".!?\"')"), _flag(bytes(range(65, 91))), _flag(bytes(range(97, 123)))


def line_features(part: T.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes, row) of every line with a word; features are shares or clipped logarithms."""
    data, bounds = part.data, part.bounds
    starts, ends, _ = T.words(data, bounds)
    l_start, l_end, _ = T.spans(data, bounds, data != 10)
    first, stop = np.searchsorted(starts, l_start), np.searchsorted(starts, l_end)
    ok = stop > first
    l_start, l_end, first, stop = l_start[ok], l_end[ok], first[ok], stop[ok]
    rows = np.searchsorted(bounds, l_start, "right") - 1
    if not len(rows):
        return np.zeros((0, FEATURES)), np.zeros(0), rows

    def over(flags: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[hi] - total[lo]).astype(float)

    def repeats(keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys, kind="stable")
        same = np.zeros(len(keys) + 1, bool)
        same[1:-1] = keys[order[1:]] == keys[order[:-1]]
        out = np.zeros(len(keys), bool)
        out[order] = same[:-1] | same[1:]
        return out

    n_words = (stop - first).astype(float)
    size = (l_end - l_start).astype(float)
    chars = over(~T.SPACE[data], l_start, l_end)
    latin = np.zeros(len(data), bool)
    latin[1:] = data[:-1] == 0xC3
    upper = over(_ASCII_UPPER[data] | (latin & (data >= 0x80) & (data <= 0x9E)), l_start, l_end)
    letters = upper + over(_ASCII_LOWER[data] | (latin & (data > 0x9E)), l_start, l_end)
    prints = T.Fingerprints(data)
    word_rows = np.searchsorted(bounds, starts, "right") - 1
    names = prints.of(starts, ends)
    salt = T.mix(word_rows.astype(np.uint64) + T.U64(1))
    again = np.zeros(len(names) + 1, np.int64)
    if len(names) >= 3:
        inside = word_rows[:-2] == word_rows[2:]
        three = names[:-2] * T.U64(3) + T.mix(names[1:-1]) * T.U64(5) + T.mix(names[2:] + T.U64(7))
        at = np.flatnonzero(inside)[repeats(T.mix(three[inside] ^ salt[:-2][inside]))]
        np.add.at(again, at, 1)
        np.add.at(again, at + 3, -1)
    repeated = np.cumsum(again)[:-1] > 0
    line_twice = repeats(T.mix(prints.of(l_start, l_end) ^ T.mix(rows.astype(np.uint64) + T.U64(3))))
    alone = (ends - starts == 1) & _SYMBOL[data[starts]]
    last = data[ends[stop - 1] - 1]
    capital = _ASCII_UPPER[data[starts]]
    per_row = np.bincount(rows, minlength=part.rows)
    doc_words = np.bincount(rows, weights=n_words, minlength=part.rows)
    lone = (np.diff(starts, append=len(data)) > 0) & (ends - starts <= 2)
    return np.stack([
        np.ones(len(rows)),
        np.minimum(np.log1p(n_words), 6) / 6,
        np.minimum(np.log1p(size), 9) / 9,
        upper / np.maximum(1, letters),
        over(_SYMBOL[data], l_start, l_end) / chars,
        over(_MARK[data], l_start, l_end) / n_words,
        over(_DIGIT[data], l_start, l_end) / chars,
        over(alone, first, stop) / n_words,
        _END[last].astype(float),
        over(repeated, first, stop) / n_words,
        line_twice.astype(float),
        np.minimum(chars / n_words, 20) / 20,
        over(capital, first, stop) / n_words,
        np.minimum(np.log1p(per_row[rows]), 6) / 6,
        np.minimum(np.log1p(doc_words[rows]), 9) / 9,
        over(lone, first, stop) / n_words,
    ], axis=1), size, rows


def with_neighbours(features: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Features of the line, of the line before and of the line after in the same document (0 at ends)."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    same = (rows[1:] == rows[:-1])[:, None]
    before[1:] = features[:-1] * same
    after[:-1] = features[1:] * same
    return np.concatenate([features, before, after], axis=1)


class Model(NamedTuple):
    """``weights``: score of "good" against "bad" by feature; ``ties``: 2 x 2 transition scores
    (row: label before; 0 bad, 1 good); ``prior``: share of good documents; ``usable``: trained."""

    weights: np.ndarray
    ties: np.ndarray
    prior: float
    usable: bool


class _Chains:
    """Documents as chains of lines, longest first, so step t touches a prefix of the documents."""

    def __init__(self, rows: np.ndarray):
        self.docs, first, sizes = np.unique(rows, return_index=True, return_counts=True)
        self.order = np.argsort(-sizes, kind="stable")
        self.first, self.sizes = first[self.order], sizes[self.order]
        self.active = np.searchsorted(-self.sizes, -np.arange(self.sizes.max(initial=0)), "left")

    def marginals(self, unary: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line, and the expected transition counts (2 x 2). ``unary``: log-odds of good."""
        n, e = len(unary), np.exp(ties - ties.max())
        pot = np.empty((n, 2))  # scaled so that the larger potential is 1
        pot[:, 0], pot[:, 1] = np.exp(np.minimum(0, -unary)), np.exp(np.minimum(0, unary))
        fwd, bwd = np.empty((n, 2)), np.ones((n, 2))
        for t, k in enumerate(self.active):
            at = self.first[:k] + t
            a = pot[at] if t == 0 else (fwd[at - 1] @ e) * pot[at]
            fwd[at] = a / a.sum(axis=1, keepdims=True)
        pairs = np.zeros((2, 2))
        for t in range(len(self.active) - 1, 0, -1):
            at = self.first[: self.active[t]] + t
            right = pot[at] * bwd[at]
            b = right @ e.T
            joint = fwd[at - 1][:, :, None] * e[None] * right[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            bwd[at - 1] = b / b.sum(axis=1, keepdims=True)
        both = fwd * bwd
        return both[:, 1] / both.sum(axis=1), pairs


def fit(features: np.ndarray, rows: np.ndarray, labels: np.ndarray, prior: float, steps: int = STEPS) -> Model:
    """Adam on the penalised conditional likelihood; ``labels``: 0/1 of each line."""
    x = with_neighbours(features, rows)
    size = x.shape[1]
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(size), np.zeros((2, 2)), prior, False)
    chains = _Chains(rows)
    inner = rows[1:] == rows[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[:-1][inner], labels[1:][inner]), 1)
    w = np.zeros(size + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p, pairs = chains.marginals(x @ w[:size], w[size:].reshape(2, 2))
        grad = np.concatenate([x.T @ (p - labels), (pairs - seen).ravel()]) / len(labels) + PENALTY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(w[:size], w[size:].reshape(2, 2), prior, True)


def _scores(part: T.Slice, model: Model) -> np.ndarray:
    out = np.full(part.rows, model.prior)
    features, size, rows = line_features(part)
    if len(rows) and model.usable:
        good, _ = _Chains(rows).marginals(with_neighbours(features, rows) @ model.weights, model.ties)
        has = np.bincount(rows, weights=size, minlength=part.rows)
        mean = np.bincount(rows, weights=size * good, minlength=part.rows)
        out[has > 0] = (mean[has > 0] / has[has > 0]).clip(0, 1)
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_docs: int = SAMPLE_DOCS) -> Model:
    """The model of a sample of at most ``sample_docs`` labelled documents; the sample's ids are broadcast
    (bounded by that number), its line features are collected."""
    ids = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
           .orderBy(F.md5(F.col("id").cast("string")), "id", "label").limit(sample_docs))
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(0), SLICE_BYTES):
                features, _, rows = line_features(part)
                at = np.searchsorted(rows, np.arange(part.rows + 1)) * FEATURES
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(part.first, part.rows), batch.column(2).slice(part.first, part.rows),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(features.ravel(), pa.float32()))],
                    ["key", "label", "features"])

    found = (chosen.select("text", F.col("id").cast("string").alias("key"), "label")
             .mapInArrow(run, "key string, label int, features array<float>").toPandas())
    if found.empty:
        return Model(np.zeros(3 * FEATURES), np.zeros((2, 2)), 0.5, False)
    found = found.sort_values(["key", "label"], kind="stable").reset_index(drop=True)  # the same sums each time
    label = found["label"].to_numpy()
    blocks = [np.asarray(x, float).reshape(-1, FEATURES) for x in found["features"]]
    rows = np.repeat(np.arange(len(blocks)), [len(b) for b in blocks])
    return fit(np.concatenate(blocks), rows, label[rows], float(label.mean()))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score and predicted (1 from a score of 0.5 on) of every document; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(1), SLICE_BYTES):
                score = _scores(part, model)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.rows), pa.array(score),
                     pa.array((score >= 0.5).astype(np.int32))], [id_col, "score", "predicted"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"`{id_col}` {kind}, score double, predicted int")


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (NULL ids: of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts
