"""Scores of a causal self-attention language model over subword ids, beside a word unigram base.

Text is lower-cased (A-Z) and split at white space; every word becomes the byte-level BPE ids of a space and
the word, and an end id closes the document. The ids are in classes (frequent ones alone, the others by
kind and frequency band); an id's probability is that of its class in context times its share of the class
after the id before it. The class comes from one attention layer: each position looks back over the inputs of
its window with content scores and a bias by distance, adds its own embedding, and a softmax over the classes
follows, whose logits start from a fixed table: the log share of each class after each input. That table and the
shares within a class are counts of pairs of ids over all training documents (rare ids by their class). Windows of ``WINDOW`` inputs overlap by half, and the
second half of each is scored, so each id is scored once with at least half a window before it (if the
document has one). ``score`` is the sum of the ids' log10 probabilities, and nothing else.

Training is data-parallel: a hash of id and text deals every training document to one round and one shard of it,
about ``SHARD_IDS`` ids each, in the order of that hash. Every shard runs Adam in numpy over its windows in batches
that only its documents fix, Spark averages the shards' weights (weighted by windows), and the next round
starts from there. The weights so follow from the documents alone, whatever the tasks and the cluster. Each
training document is cut into windows like those of the scores, so every id is a target once.

Base: counts of all training words are summed in Spark. The most frequent words, at most ``TOP_WORDS``, go to
all tasks; the rest of each document's words is joined with the counts. A word is named by the fingerprint of its ids;
the ids also show where words begin, so texts are read only to be encoded.

Defined results: a NULL or empty text is the end alone; without training documents the counts are 0, the
base is log10(0.1 / 0.1) = 0 a token and the model is its start (uniform shares); rows are scored one by one
(repeated rows alike); a NULL id counts as the empty string in the fold; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispersa.llm import text as T
from dispersa.llm.shared import per_worker, release_worker, written

WINDOW = 16
HALF = WINDOW // 2
CLASSES = 64
ALONE = 40  # ids that are classes of their own
OWN = 1024  # ids with an embedding of their own; the others share one by class
WIDTH, KEY = 24, 8
ROUNDS = 2
BATCH = 512  # windows of a training step
STACK = 256  # rows of a product
SHARD_IDS = 2_000_000  # training ids of a shard in a round, about
CHUNK_DOCS = 256  # documents of a shard whose windows are mixed
RATE = 0.02
TOP_WORDS = 1 << 18
CACHED_WORDS = 1 << 19  # in a worker, about 30 bytes each
COUNTED_WORDS = 1 << 19  # distinct words whose counts a task holds before it passes them on
COUNTS_A_ROW = 1 << 16
SCORED_BYTES = 1 << 17  # of ids scored together
CODED_BYTES = 1 << 20  # of texts whose words are looked up together
LEAN = 10.0  # counts that an input's row of the pair tables borrows from the shares whatever the input
SUM_SHARDS = 16  # shards whose weights one task adds
BLOCKS = 512  # half windows scored at once
SMOOTH = 0.1


# --- subword ids ------------------------------------------------------------------------------------------

class Subwords:
    """Ids of words, kept for the next texts; ``end`` is the id after the vocabulary's last."""

    def __init__(self, path: str):
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        pattern = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")  # the vocabulary's
        self.bpe = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.kind = _kind(self.end)
        self.starts_word = np.zeros(self.end + 1, bool)
        for token, i in ranks.items():
            self.starts_word[i] = token[:1] == b" "
        # Known words: sorted fingerprints of their bytes, names, and where their ids lie in ``pool``.
        self.prints, self.names = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.kind)

    def _make(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        text = b" ".join(words).decode()
        # As one text: a piece begins at each space between the words, as it does at a word alone, and the ids that begin
        # with a space tell the words apart. Not so next to other white space, which the pattern may look beyond.
        if len(text.split()) != len(words):
            lists = [self.bpe.encode_ordinary(" " + w) for w in text.split(" ")]
            return np.concatenate(lists).astype(self.kind), np.array([len(x) for x in lists])
        ids = self.bpe.encode_to_numpy(" " + text, disallowed_special=())
        return ids.astype(self.kind), np.diff(np.append(np.flatnonzero(self.starts_word[ids]), len(ids)))

    def of_words(self, prints: np.ndarray, words: Callable[[np.ndarray], list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names of the words with sorted distinct fingerprints ``prints``, and where in ``pool`` their ids begin and how
        many there are; ``words`` gives the words at some places of ``prints``."""
        at = np.searchsorted(self.prints, prints)
        known = np.append(self.prints, 0)[at] == prints
        known &= at < len(self.prints)
        new = np.flatnonzero(~known)
        if len(new):
            ids, sizes = self._make(words(new))
            if len(self.prints) + len(new) > CACHED_WORDS:  # of the known ones only these texts' words stay
                old = at[known]
                self.pool = self.pool[ranges(self.starts[old], self.sizes[old])]
                self.prints, self.names, self.sizes = self.prints[old], self.names[old], self.sizes[old]
                self.starts = np.cumsum(self.sizes) - self.sizes
                at = np.searchsorted(self.prints, prints)
            until = np.cumsum(sizes)
            more = prints[new], word_names(ids, until - sizes, until, self.end), len(self.pool) + until - sizes, sizes
            self.pool = np.append(self.pool, ids)
            self.prints, self.names, self.starts, self.sizes = (
                np.insert(x, at[new], y) for x, y in zip((self.prints, self.names, self.starts, self.sizes), more))
            at = np.searchsorted(self.prints, prints)
        return self.names[at], self.starts[at], self.sizes[at]


def word_names(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, end: int) -> np.ndarray:
    """Names of words by their ids, of which each word has its own: fingerprints of fewer units than bytes."""
    codes = per_worker("id codes", lambda: T.mix(np.arange(1, 1 << 16, dtype=np.uint64)))
    return T.Fingerprints(codes[ids] if end < len(codes) else T.mix(ids.astype(np.uint64) + np.uint64(1))).of(starts, ends)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places from each start on, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def subwords(path: str) -> Subwords:
    return per_worker(("subwords", path), lambda: Subwords(path))


def fold(id_col: str, parts: int) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


# --- counts -----------------------------------------------------------------------------------------------

def id_counts(counted: DataFrame, end: int) -> np.ndarray:
    """Counts of all ids in the training documents, ends included, from (name, c) of ids by task; collected as one
    number an id."""
    found = counted.groupBy("name").agg(F.sum("c").alias("c")).toPandas()
    out = np.zeros(end + 1, np.int64)
    out[found["name"].to_numpy(np.int64)] = found["c"].to_numpy(np.int64)
    return out


# --- model ------------------------------------------------------------------------------------------------

class Vocabulary(NamedTuple):
    """Class, embedding row, and log share of the row of each id."""

    of_class: np.ndarray
    row: np.ndarray
    log_share: np.ndarray

    @staticmethod
    def build(counts: np.ndarray, starts_word: np.ndarray) -> Vocabulary:
        order = np.argsort(-counts, kind="stable")
        of_class = np.empty(len(counts), np.int64)
        of_class[order[:ALONE]] = np.arange(ALONE)
        bands = (CLASSES - ALONE) // 2
        for kind in (0, 1):  # the others: words' first ids and the rest, in bands of like mass
            ids = order[ALONE:][starts_word[order[ALONE:]] == bool(kind)]
            mass = np.cumsum(counts[ids] + SMOOTH)
            of_class[ids] = ALONE + kind * bands + np.minimum((mass / max(mass[-1], 1) * bands).astype(int), bands - 1)
        rank = np.empty(len(counts), np.int64)
        rank[order] = np.arange(len(counts))
        row = np.where(rank < OWN, rank, OWN + of_class)
        smoothed = counts + SMOOTH
        share = smoothed / np.bincount(row, weights=smoothed)[row]
        return Vocabulary(of_class, row, np.log(share))


PAD = OWN + CLASSES  # embedding row before a document's start
ROWS = PAD + 1
SHAPES = {"x": (ROWS, WIDTH), "wq": (WIDTH, KEY), "wk": (WIDTH, KEY), "wv": (WIDTH, WIDTH),
          "far": (WINDOW,), "wo": (WIDTH, CLASSES), "b": (CLASSES,)}
_SIZES = [int(np.prod(s)) for s in SHAPES.values()]


def _unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    parts = np.split(flat, np.cumsum(_SIZES)[:-1])
    return {n: p.reshape(s) for (n, s), p in zip(SHAPES.items(), parts)}


def initial() -> np.ndarray:
    """Small random weights; the first logits are those of the table of pairs."""
    rng = np.random.default_rng(11)
    w = {n: rng.normal(0, 0.3 if n == "x" else s[0] ** -0.5, s) for n, s in SHAPES.items()}
    w["far"] = -0.1 * np.arange(WINDOW)
    w["b"] = np.zeros(CLASSES)
    w["wo"] *= 0.1
    return np.concatenate([w[n].ravel() for n in SHAPES]).astype(np.float32)


# Distance of key j (0 to WINDOW - 1) from query i (the second half), and what may be seen.
_DISTANCE = (np.arange(HALF)[:, None] + HALF) - np.arange(WINDOW)[None, :]
_SEEN = _DISTANCE >= 0
_HIDDEN = np.where(_SEEN, 0, -1e9).astype(np.float32)


class Room:
    """Arrays that every step uses again: new ones of their size would be cleared page by page each time."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, kind: type = np.float32) -> np.ndarray:
        n = int(np.prod(shape))
        have = self.held.get(name)
        if have is None or len(have) < n or have.dtype != kind:
            have = self.held[name] = np.empty(n, kind)
        return have[:n].reshape(shape)


def _taken(table: np.ndarray, rows: np.ndarray, out: np.ndarray) -> np.ndarray:
    return np.take(table, rows, axis=0, out=out, mode="clip")  # other modes copy ``out``


def _exp(z: np.ndarray, bound: float = np.inf) -> np.ndarray:
    """In place; logits are small by construction, so a limit does instead of the maximum, and none if no
    logit is over ``bound``."""
    if not bound <= 60:
        np.minimum(z, 60, out=z)
    return np.exp(z, out=z)


def _values_and_keys(w: dict[str, np.ndarray]) -> np.ndarray:
    """A row for each embedding: its value, then its key."""
    return w["x"] @ np.concatenate([w["wv"], w["wk"]], axis=1)


def _over_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of two tall arrays, in stacks of rows that fit a core's cache."""
    n = len(a) // STACK * STACK
    stacks = lambda y: y[:n].reshape(-1, STACK, y.shape[1])
    return a[n:].T @ b[n:] + (stacks(a).transpose(0, 2, 1) @ stacks(b)).sum(axis=0)


def _times(a: np.ndarray, b: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``a @ b`` of a tall array, in stacks of rows."""
    n = len(a) // STACK * STACK
    stacks = lambda y: y[:n].reshape(-1, STACK, y.shape[1])
    np.matmul(stacks(a), b, out=stacks(out))
    np.matmul(a[n:], b, out=out[n:])
    return out


def step(w: dict[str, np.ndarray], pairs: np.ndarray, rows: np.ndarray, target: np.ndarray,
         known: np.ndarray, room: Room | None = None) -> tuple[float, np.ndarray]:
    """Loss a token and gradient for windows: ``rows`` (n, WINDOW) inputs, ``target`` (n, HALF) classes,
    ``known`` (n, HALF) false beyond a document's end; ``pairs``: logits of the classes after each input.
    Keys, values and queries are looked up by embedding row, and their gradients are summed by row before they go on.
    The softmax over the classes stays undivided (``u``): what is narrower is divided."""
    room = room or Room()
    x = w["x"]
    kind, scale = x.dtype, x.dtype.type(KEY ** -0.5)
    flat = lambda y: y.reshape(-1, y.shape[-1])
    size, m = len(rows), len(rows) * HALF
    of_targets = lambda y: y.reshape(size, HALF, -1)
    every, here = rows.ravel(), rows[:, HALF:].ravel()
    wq = w["wq"] * scale
    queries, table = x @ wq, _values_and_keys(w)
    vk = _taken(table, rows, room("vk", size, WINDOW, WIDTH + KEY, kind=kind))
    v, k = vk[:, :, :WIDTH], vk[:, :, WIDTH:]
    q = of_targets(_taken(queries, here, room("q", m, KEY, kind=kind)))
    # A copy of the turned keys: small products with a turned second factor are slow.
    turned = room("turned", size, KEY, WINDOW, kind=kind)
    turned[:] = k.transpose(0, 2, 1)
    a = np.matmul(q, turned, out=room("a", size, HALF, WINDOW, kind=kind))
    bias = (w["far"][np.maximum(_DISTANCE, 0)] + _HIDDEN).astype(kind)
    a += bias
    _exp(a, _longest(queries) * _longest(table[:, WIDTH:]) + float(bias.max()))
    begins = np.flatnonzero(rows[:, 0] == PAD)  # only these windows have places before the document
    a[begins] *= (rows[begins] != PAD)[:, None, :]
    a *= (1 / np.einsum("nij->ni", a))[:, :, None]
    h = np.matmul(a, v, out=room("h", size, HALF, WIDTH, kind=kind))
    h += of_targets(_taken(x, here, room("e", m, WIDTH, kind=kind)))
    h = flat(np.tanh(h, out=h))
    after = np.add(pairs, w["b"], out=room("after", ROWS, CLASSES, kind=kind))
    u = _times(h, w["wo"], room("u", m, CLASSES, kind=kind))
    u += _taken(after, here, room("taken", m, CLASSES, kind=kind))
    _exp(u, float(np.abs(w["wo"]).sum(axis=0).max() + after.max()))  # tanh is below 1
    whole = np.einsum("ij->i", u)
    aims, valid = target.ravel(), known.ravel()
    n = max(1, int(valid.sum()))
    cell = np.arange(0, u.size, CLASSES) + aims
    at = u.ravel()[cell]
    loss = -float(np.log(np.maximum(at / whole, 1e-30))[valid].sum()) / n
    u.ravel()[cell] = at - whole
    part = (valid / (n * whole)).astype(kind)  # the logits' gradient is part * u
    dmix = _times(u, w["wo"].T.copy(), room("dmix", m, WIDTH, kind=kind))
    dmix *= part[:, None]
    dwo = _over_rows(np.multiply(h, part[:, None], out=room("hp", m, WIDTH, kind=kind)), u)
    db = part @ u
    h *= h
    dmix *= np.subtract(1, h, out=h)
    dmix = of_targets(dmix)
    ds = np.matmul(dmix, v.transpose(0, 2, 1), out=room("ds", size, HALF, WINDOW, kind=kind))
    ds -= np.einsum("nij,nij->ni", a, ds)[:, :, None]
    ds *= a
    # Gradients of the values and keys at all inputs, of the own embeddings and queries at the second halves'.
    dvk = room("dvk", size, WINDOW, WIDTH + KEY, kind=kind)
    np.matmul(a.transpose(0, 2, 1), dmix, out=dvk[:, :, :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=dvk[:, :, WIDTH:])
    dxq = room("dxq", size, HALF, WIDTH + KEY, kind=kind)
    dxq[:, :, :WIDTH] = dmix
    np.matmul(ds, k, out=dxq[:, :, WIDTH:])
    dvk, dxq = _by_row(every, flat(dvk), room), _by_row(here, flat(dxq), room)
    dq, dwvk = dxq[:, WIDTH:], x.T @ dvk
    dx = dvk @ np.concatenate([w["wv"], w["wk"]], axis=1).T + dxq[:, :WIDTH] + dq @ wq.T
    far = np.bincount(np.maximum(_DISTANCE, 0).ravel(), weights=(ds.sum(axis=0) * _SEEN).ravel(), minlength=WINDOW)
    grad = {"x": dx, "wq": x.T @ dq * scale, "wk": dwvk[:, WIDTH:], "wv": dwvk[:, :WIDTH], "far": far, "wo": dwo, "b": db}
    return loss, np.concatenate([grad[n].ravel() for n in SHAPES]).astype(np.float32)


def _longest(vectors: np.ndarray) -> float:
    return float(np.einsum("ij,ij->i", vectors, vectors).max()) ** 0.5


def _by_row(rows: np.ndarray, values: np.ndarray, room: Room) -> np.ndarray:
    """Sums of ``values`` by embedding row."""
    order = np.argsort(rows.astype(np.int16), kind="stable")
    ranked = rows[order]
    first = np.append(0, np.flatnonzero(ranked[1:] != ranked[:-1]) + 1)
    out = np.zeros((ROWS, values.shape[1]), values.dtype)
    # As complex numbers two columns are added in one go.
    values = _taken(values, order, room("ranked", *values.shape, kind=values.dtype)).view(np.result_type(values, np.complex64))
    out[ranked[first]] = np.add.reduceat(values, first).view(out.dtype)
    return out


class Scorer:
    """Class log-probabilities by tables of the trained weights: one row of keys, values and queries for
    each embedding. Documents lie one after the other, each behind half a window of places before its start, so a
    window is two neighbouring halves and nothing is looked up twice."""

    def __init__(self, flat: np.ndarray, pairs: np.ndarray, within: np.ndarray, vocabulary: Vocabulary):
        w = _unpack(flat.astype(np.float32))
        self.q, self.x = w["x"] @ w["wq"] * np.float32(KEY ** -0.5), w["x"]
        self.table = _values_and_keys(w)
        self.bias = (w["far"][np.maximum(_DISTANCE, 0)] + _HIDDEN).astype(np.float32)
        self.wo, self.after = w["wo"], (pairs + w["b"]).astype(np.float32)
        self.bound = float(np.abs(self.wo).sum(axis=0).max() + self.after.max())
        self.score_bound = _longest(self.q) * _longest(self.table[:, WIDTH:]) + float(self.bias.max())
        self.vocabulary, self.within = vocabulary, within
        self.room = Room()

    def logs(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """log10 probability of each id; ``ids`` holds the documents, each with its end id, one after the
        other, ``bounds`` their borders."""
        sizes, room = np.diff(bounds), self.room
        halves = -(-sizes // HALF) + 1
        begins = np.cumsum(halves) - halves
        at = np.arange(len(ids)) + np.repeat((begins + 1) * HALF - bounds[:-1], sizes)
        rows = self.vocabulary.row[ids]
        before = np.empty_like(rows)
        before[1:] = rows[:-1]
        before[bounds[:-1]] = self.vocabulary.row[-1]  # a document's first input is the end id
        inputs = np.full((int(halves.sum()), HALF), PAD)
        inputs.ravel()[at] = before
        aims = np.zeros(inputs.shape, np.int64)
        aims.ravel()[at] = self.vocabulary.of_class[ids]
        logs = np.zeros(inputs.shape, np.float32)
        for lo in range(1, len(inputs), BLOCKS):
            x = inputs[lo: lo + BLOCKS]
            size, m = len(x), x.size
            vk = _taken(self.table, inputs[lo - 1: lo + size], room("vk", size + 1, HALF, WIDTH + KEY))
            turned = room("turned", size + 1, KEY, HALF)
            turned[:] = vk[:, :, WIDTH:].transpose(0, 2, 1)
            v = np.lib.stride_tricks.as_strided(vk, (size, WINDOW, WIDTH), vk.strides, writeable=False)
            q = _taken(self.q, x, room("q", size, HALF, KEY))
            a = room("a", size, HALF, WINDOW)
            np.matmul(q, turned[:-1], out=a[:, :, :HALF])
            np.matmul(q, turned[1:], out=a[:, :, HALF:])
            a += self.bias
            _exp(a, self.score_bound)
            first = begins[np.searchsorted(begins, lo - 1): np.searchsorted(begins, lo + size - 1)] - lo + 1
            a[first, :, :HALF] = 0  # places before a document weigh nothing
            a *= (1 / np.einsum("nij->ni", a))[:, :, None]
            h = np.matmul(a, v, out=room("h", size, HALF, WIDTH))
            h += _taken(self.x, x, room("e", size, HALF, WIDTH))
            # A product's last bits follow a row's place in it: one product a window keeps scores free of the batches.
            z = np.matmul(np.tanh(h, out=h), self.wo, out=room("z", size, HALF, CLASSES))
            z += _taken(self.after, x, room("after", size, HALF, CLASSES))
            got = z.ravel()[np.arange(0, z.size, CLASSES) + aims[lo: lo + size].ravel()]
            if self.bound > 60:
                np.minimum(got, 60, out=got)
            logs[lo: lo + size] = got.reshape(size, HALF) - np.log(np.einsum("nij->ni", _exp(z, self.bound)))
        out = self.vocabulary.log_share[ids]
        out += logs.ravel()[at] + self.within.ravel()[before * ROWS + rows]
        return out / np.log(10)


class Coded(NamedTuple):
    """Ids of documents with their ends, and document borders; names of the distinct words, and which of them each
    word is, row by row (``before``: words before each row)."""

    ids: np.ndarray
    bounds: np.ndarray
    names: np.ndarray
    which: np.ndarray
    before: np.ndarray


def code(part: T.Slice, sub: Subwords) -> Coded:
    """Words are told apart by the fingerprints of their bytes; each distinct one is looked up once."""
    lowered, bounds = T.LOWER[part.data], part.bounds
    starts, ends, before = T.words(lowered, bounds)
    named = np.empty(len(starts), np.uint64)
    for lo, hi in stretches(bounds, T.SLICE_BYTES):
        mine = slice(before[lo], before[hi])
        named[mine] = T.Fingerprints(lowered[bounds[lo]: bounds[hi]]).of(starts[mine] - bounds[lo], ends[mine] - bounds[lo])
    order = np.argsort(named)
    ranked = named[order]
    begins = np.ones(len(ranked), bool)
    begins[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(ranked), np.int64)
    which[order] = np.cumsum(begins) - 1
    one, raw = order[begins], lowered.tobytes()
    names, start, size = sub.of_words(
        ranked[begins], lambda at: [raw[s:e] for s, e in zip(starts[one[at]].tolist(), ends[one[at]].tolist())])
    start, size = start[which], size[which]
    until = np.concatenate([[0], np.cumsum(size)])
    out_bounds = until[before] + np.arange(part.rows + 1)
    ids = np.full(out_bounds[-1], sub.end, sub.kind)
    inside = np.ones(len(ids), bool)
    inside[out_bounds[1:] - 1] = False
    ids[inside] = sub.pool[ranges(start, size)]
    return Coded(ids, out_bounds, names, which, before)


def stretches(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` units (or a single longer row)."""
    lo = 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def summed(names: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts by name."""
    order = np.argsort(names)
    names = names[order]
    first = np.flatnonzero(np.append(True, names[1:] != names[:-1])[:len(names)])
    return names[first], np.add.reduceat(counts[order], first) if len(first) else counts


# --- training ---------------------------------------------------------------------------------------------

def coded_documents(docs: DataFrame, train_on: Column, path: str, id_col: str, text_col: str) -> DataFrame:
    """(id, learn, ids, mark): every document with all its ids and its end as bytes (``_kind``), written once;
    ``mark``: a hash of document id and ids, which deals and orders the training documents."""
    return coded_and_counted(docs, train_on, path, id_col, text_col)[0]


def coded_and_counted(docs: DataFrame, train_on: Column, path: str, id_col: str,
                      text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``coded_documents``, (name, c): counts of the training documents' words by their names, and a task's counts of
    their ids in the same form. Tasks pass on sums of many rows (as rows of their own, ``learn`` NULL, those of ids with
    empty ``ids``), so a word in every row is no hot key."""
    kind = dict(docs.dtypes)[id_col]
    small = _kind(subwords(path).end)
    names = ["id", "learn", "ids", "names", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = subwords(path)
        held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        of_ids = np.zeros(sub.end + 1, np.int64)
        longs, types = pa.list_(pa.int64()), None

        def out(keys: np.ndarray, counts: np.ndarray, ids: bytes | None) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(keys), COUNTS_A_ROW):
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))
                         for x in (keys[lo: lo + COUNTS_A_ROW].view(np.int64), counts[lo: lo + COUNTS_A_ROW])]
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in types), pa.array([ids], pa.binary()), *lists], names)

        for batch in batches:
            types = [batch.column(0).type, batch.column(2).type]
            learn = batch.column(2).to_numpy(zero_copy_only=False)
            for part in T.slices(batch.column(1), CODED_BYTES):
                coded = code(part, sub)
                lists = pa.Array.from_buffers(pa.binary(), part.rows, [
                    None, pa.py_buffer((coded.bounds * coded.ids.itemsize).astype(np.int32)), pa.py_buffer(coded.ids)])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(part.first, part.rows) for c in (0, 2)), lists, *[pa.nulls(part.rows, longs)] * 2], names)
                mine = np.repeat(learn[part.first: part.first + part.rows], np.diff(coded.before))
                counts = np.bincount(coded.which[mine], minlength=len(coded.names))
                seen = np.flatnonzero(counts)
                held = summed(np.append(held[0], coded.names[seen]), np.append(held[1], counts[seen]))
                of_ids += np.bincount(coded.ids[np.repeat(learn[part.first: part.first + part.rows], np.diff(coded.bounds))],
                                      minlength=len(of_ids))
                if len(held[0]) > COUNTED_WORDS:
                    yield from out(*held, None)
                    held = held[0][:0], held[1][:0]
        yield from out(*held, None)
        seen = np.flatnonzero(of_ids)
        yield from out(seen, of_ids[seen], b"")

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train_on, F.lit(False)).alias("learn"))
    both = rows.mapInArrow(run, f"id {kind}, learn boolean, ids binary, names array<long>, counts array<long>")
    both = written(both.withColumn("mark", F.xxhash64("id", "ids")), "lm-ids", compression="none")
    counts = both.filter("learn IS NULL").select("ids", F.explode(F.arrays_zip("names", "counts")).alias("w")).select(
        "ids", F.col("w.names").alias("name"), F.col("w.counts").alias("c"))
    words = counts.filter("ids IS NULL").groupBy("name").agg(F.sum("c").alias("c"))
    return (both.filter("learn IS NOT NULL").select("id", "learn", "ids", "mark"), written(words, "word-counts"),
            counts.filter("ids IS NOT NULL").select("name", "c"))


def _kind(end: int) -> str:
    """How ids are kept: two bytes where the vocabulary allows it."""
    return "<u2" if end < 1 << 16 else "<i4"


def _offsets(lists: pa.Array) -> np.ndarray:
    return np.frombuffer(lists.buffers()[1], np.int32)[lists.offset: lists.offset + len(lists) + 1].astype(np.int64)


def _of_lists(lists: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a column of id bytes, and the documents' borders."""
    data, at = lists.buffers()[2], _offsets(lists)
    kind = np.dtype(_kind(end))
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(kind).astype(np.int64), (at - at[0]) // kind.itemsize


def pair_tables(learn: DataFrame, vocabulary: Vocabulary, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logs of the share of each class after each input (embedding row), and of each row's share of its class
    after each input, counted over all training ids; few counts lean on the shares whatever the input. One number
    a cell comes to the driver (at most ROWS x ROWS)."""
    shared = learn.sparkSession.sparkContext.broadcast(vocabulary.row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of = shared.value
        total = np.zeros(ROWS * ROWS, np.int64)
        for batch in batches:
            ids, bounds = _of_lists(batch.column(0), len(row_of) - 1)
            rows = row_of.take(ids)
            cell = np.append(0, rows[:-1])
            cell[bounds[:-1]] = row_of[-1]  # a document's first input is the end id
            cell *= ROWS
            cell += rows
            total += np.bincount(cell, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["cell", "n"])

    found = (learn.select("ids").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
             .toArrow())
    n = np.zeros(ROWS * ROWS)
    n[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    n = n.reshape(ROWS, ROWS)
    class_of = np.zeros(ROWS, np.int64)
    class_of[vocabulary.row] = vocabulary.of_class
    mass = np.bincount(vocabulary.row, weights=counts + SMOOTH, minlength=ROWS)
    share = mass / np.maximum(np.bincount(class_of, weights=mass, minlength=CLASSES), 1e-300)[class_of]
    by_class = np.zeros((ROWS, CLASSES))
    for c in range(CLASSES):
        by_class[:, c] = n[:, class_of == c].sum(axis=1)
    own = by_class.sum(axis=0) + SMOOTH
    own /= own.sum()
    pairs = np.log((by_class + LEAN * own) / (by_class.sum(axis=1, keepdims=True) + LEAN))
    within = np.log(np.maximum((n + LEAN * share) / (by_class[:, class_of] + LEAN), 1e-30))  # rows without ids: never read
    return pairs.astype(np.float32), within.astype(np.float32)


def windows(ids: np.ndarray, bounds: np.ndarray, end: int, number: int) -> Iterator[np.ndarray]:
    """The documents' windows, ``BATCH`` at once in an order that ``number`` seeds: WINDOW inputs and the target after
    the last one, -1 before a document's start and beyond its end. Each id is a target of one window."""
    sizes = np.diff(bounds)
    blocks = -(-sizes // HALF)
    # Each document behind HALF places and the end id, filled up to whole halves: a window is WINDOW + 1 places in a row.
    first = np.cumsum(blocks + 2) - blocks - 2
    laid = np.full(int((blocks + 2).sum()) * HALF, -1, np.int64)
    laid[(first + 1) * HALF] = end
    laid[np.arange(len(ids)) + np.repeat((first + 1) * HALF + 1 - bounds[:-1], sizes)] = ids
    begin = ranges(first, blocks)
    step_bytes = laid.itemsize
    cut = np.lib.stride_tricks.as_strided(laid, (len(laid) // HALF - 2, WINDOW + 1), (HALF * step_bytes, step_bytes), writeable=False)
    mine = np.random.default_rng(number).permutation(len(begin))  # windows of many documents in a step
    for lo in range(0, len(mine), BATCH):
        yield cut[begin[mine[lo: lo + BATCH]]]


class _Shard:
    """Adam over the documents of one shard, chunk by chunk."""

    def __init__(self, start: np.ndarray, pairs: np.ndarray, rows: np.ndarray, classes: np.ndarray, number: int):
        self.w, self.m, self.v = start.copy(), np.zeros_like(start), np.zeros_like(start)
        self.pairs, self.rows, self.classes, self.number = pairs, rows, classes, number
        self.seen = self.t = self.docs = 0
        self.held: list[np.ndarray] = []
        self.room = Room()

    def add(self, ids: np.ndarray, bounds: np.ndarray) -> None:
        at = 0
        while at < len(bounds) - 1:
            end = min(len(bounds) - 1, at + CHUNK_DOCS - self.docs)
            self.held += [ids[bounds[i]: bounds[i + 1]] for i in range(at, end)]
            self.docs += end - at
            at = end
            if self.docs == CHUNK_DOCS:
                self.learn()

    def learn(self) -> None:
        if not self.held:
            return
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in self.held])])
        for part in windows(np.concatenate(self.held), bounds, len(self.rows) - 2, self.number):
            rows, y = self.rows.take(part[:, :WINDOW]), part[:, HALF + 1:]
            _, g = step(_unpack(self.w), self.pairs, rows, self.classes.take(y), y >= 0, self.room)
            self.t += 1
            self.m *= np.float32(0.9)
            self.v *= np.float32(0.99)
            self.m += np.float32(0.1) * g
            g *= g
            g *= np.float32(0.01)
            self.v += g
            rate = RATE / (1 + self.number) / (1 - 0.9 ** self.t) * (1 - 0.99 ** self.t) ** 0.5
            root = np.sqrt(self.v, out=g)
            root += np.float32(1e-6)
            move = np.divide(self.m, root, out=root)
            move *= np.float32(rate)
            self.w -= move
            self.seen += len(part)
        self.held, self.docs = [], 0


def dealt(learn: DataFrame, end: int, rounds: int, n_ids: int | None = None) -> tuple[DataFrame, int]:
    """(ids, mark, round, shard) of ``learn (ids, mark)`` and the number of shards of a round, which follows from the
    ids of the documents: each document is in one shard of one round."""
    if n_ids is None:
        n_ids = (learn.agg(F.sum(F.length("ids")).alias("n")).first().n or 0) // np.dtype(_kind(end)).itemsize
    shards = -(-n_ids // (rounds * SHARD_IDS))
    slot = F.pmod("mark", F.lit(max(1, shards) * rounds)).cast("int")
    return learn.select("ids", "mark", (slot % rounds).alias("round"), F.floor(slot / rounds).cast("int").alias("shard")), shards


def train(learn: DataFrame, pairs: np.ndarray, vocabulary: Vocabulary, n_ids: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after ``rounds`` rounds of local Adam by shard and averaging over ``learn (ids, mark)``."""
    spark = learn.sparkSession
    flat = initial()
    row_of = np.append(vocabulary.row, PAD)  # -1: before the start
    class_of = np.append(vocabulary.of_class, 0)
    deal, shards = dealt(learn, len(vocabulary.row) - 1, rounds, n_ids)
    for number in range(rounds if shards else 0):
        shared = spark.sparkContext.broadcast((flat, pairs, row_of, class_of))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_worker()  # the encoder's cache
            here, current = None, None

            def out() -> pa.RecordBatch:
                here.learn()
                flat_weights = pa.array(here.w.astype(np.float64) * here.seen)
                return pa.RecordBatch.from_arrays(
                    [pa.array([current], pa.int32()), pa.array([here.seen], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(here.w)], pa.int32()), flat_weights)], ["shard", "n", "w"])

            for batch in batches:
                shard = batch.column(1).to_numpy()
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]) if len(shard) else []
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    if current != shard[lo]:
                        if here is not None:
                            yield out()
                        here, current = _Shard(*shared.value, number), shard[lo]
                    here.add(*_of_lists(batch.column(0).slice(lo, hi - lo), len(row_of) - 1))
            if here is not None:
                yield out()

        trained = (deal.filter(F.col("round") == number).select("ids", "mark", "shard")
                   .repartitionById(shards, "shard").sortWithinPartitions("shard", "mark").select("ids", "shard")
                   .mapInArrow(run, "shard int, n long, w array<double>"))
        mean = _mean(trained, shards)
        if mean is not None:
            flat = mean.astype(np.float32)
    return flat


def _mean(trained: DataFrame, shards: int) -> np.ndarray | None:
    """Mean of the shards' weights: sums of SUM_SHARDS shards in their order, then of such sums, so that neither
    the result nor what a task or the driver holds follows the tasks. One array comes to the driver."""

    def add(key, table):
        order = np.argsort(table.column("shard").to_numpy())
        rows = table.column("w").to_pylist()
        total = np.sum([rows[i] for i in order], axis=0)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "n": [sum(table.column("n").to_pylist())],
                         "w": pa.array([total.tolist()], pa.list_(pa.float64()))})

    while shards > 1:
        shards = -(-shards // SUM_SHARDS)
        trained = trained.groupBy((F.col("shard") / SUM_SHARDS).cast("int").alias("shard_group")).applyInArrow(
            add, "shard int, n long, w array<double>")
    rows = trained.collect()
    return np.array(rows[0].w) / rows[0].n if rows and rows[0].n else None


# --- scores -----------------------------------------------------------------------------------------------

def score_documents(docs: DataFrame, subword_path: str, train_on: Column, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document row: id, n_tokens, n_known, train_tokens, base_score, score. ``train_on`` is the
    condition on ``docs`` that picks the documents to learn from."""
    spark = docs.sparkSession
    coded, words, ids = coded_and_counted(docs, train_on, subword_path, id_col, text_col)
    learn = coded.filter("learn")
    counts = id_counts(ids, subwords(subword_path).end)
    n_docs = int(counts[-1])  # one end each
    sums = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = (sums.n or 0) + n_docs, sums.v + (n_docs > 0)
    vocabulary = Vocabulary.build(counts, subwords(subword_path).starts_word)
    pairs, within = pair_tables(learn, vocabulary, counts)
    flat = train(learn, pairs, vocabulary, int(counts.sum()))

    # The frequent words: all from the least count on that at most TOP_WORDS words reach.
    spread = words.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).limit(TOP_WORDS).toPandas()
    reach = spread["c"][spread["n"].cumsum() <= TOP_WORDS]
    top = words.filter(F.col("c") >= int(reach.min() if len(reach) else 1 << 62)).toPandas()
    names, c = top["name"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    order = np.argsort(names)
    names, c = names[order], c[order]
    whole = np.log10(n + SMOOTH * (v + 1))
    stops = subwords(subword_path).starts_word.copy()
    stops[-1] = True  # the end id
    shared = spark.sparkContext.broadcast((names, c, flat, pairs, within, tuple(vocabulary), stops))  # plain: no class to import

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, c, flat, pairs, within, vocabulary, stops = shared.value
        end = len(stops) - 1
        scorer = Scorer(flat, pairs, within, Vocabulary(*vocabulary))
        log_c = np.log10(c + SMOOTH)
        # Names are spread evenly: their first bits give a place just before, or at, each one's among the frequent ones.
        bits = len(names).bit_length() + 1
        shift, upward = np.uint64(64 - bits), np.append(names, np.uint64(2 ** 64 - 1))
        first = np.searchsorted(names, np.arange(1 << bits, dtype=np.uint64) << shift)
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi in stretches(_offsets(batch.column(1)), SCORED_BYTES):
                ids, bounds = _of_lists(batch.column(1).slice(lo, hi - lo), end)
                logs = np.add.reduceat(scorer.logs(ids, bounds), bounds[:-1])
                # A word's ids reach from one that begins with a space to the next such one, or the end.
                at = np.flatnonzero(stops[ids])
                begins = ids[at] != end
                starts, ends = at[begins], at[1:][begins[:-1]]
                before = np.searchsorted(starts, bounds)
                mine = word_names(ids, starts, ends, end)
                rows = np.repeat(np.arange(hi - lo), np.diff(before))
                at = first[mine >> shift]
                less = np.flatnonzero(upward[at] < mine)
                while len(less):
                    at[less] += 1
                    less = less[upward[at[less]] < mine[less]]
                top = (upward[at] == mine) & (at < len(names))  # among the most frequent
                at = at[top]
                per_row = lambda x: np.bincount(rows[top], weights=x, minlength=hi - lo)
                rare = ~top
                cut = np.searchsorted(rows[rare], np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(row_id + np.arange(hi - lo)),
                     pa.array(np.diff(before) + 1), pa.array(per_row(log_c[at]) + np.log10(n_docs + SMOOTH)),
                     pa.array(per_row(c[at] > 0).astype(np.int64) + int(n_docs > 0)), pa.array(logs),
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(mine[rare].view(np.int64)))],
                    [id_col, "row_id", "n_tokens", "base", "known", "score", "rare"])
                row_id += hi - lo

    kind = dict(docs.dtypes)[id_col]
    scored = written(coded.select("id", "ids").mapInArrow(
        run, f"`{id_col}` {kind}, row_id long, n_tokens long, base double, known long, score double, rare array<long>"),
        "lm-scores")
    # The other words: joined with the counts, summed by row.
    rest = (scored.select("row_id", F.explode("rare").alias("name")).join(words, "name", "left")
            .groupBy("row_id").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTH))).alias("more"),
                                   F.count("c").alias("more_known")))
    return scored.join(rest, "row_id", "left").select(
        F.col(id_col), "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(whole))).alias("base_score"),
        "score")
