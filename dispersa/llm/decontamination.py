"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Words are runs of ASCII digits, letters (A-Z lowered) and non-ASCII characters. The automaton's
transitions are item words; a document's words stream through it and the length of the longest match
ending at each word is tracked. A match of ``window`` words or more covers windows of some items, so its
words are hit; an item of fewer words is one window. A word of no item sets the automaton to its root, so
only stretches of item words are streamed word by word.

The items are a stated query set: they are read in blocks of at most ``BLOCK_WORDS`` words, one automaton
and one narrow pass over the documents per block; a pass adds to the hits of the passes before it, so any
number of items gives whole results without a shuffle.

Defined results: NULL text or an empty one has no words and is clean; an item without words (or NULL)
never occurs; an item with a NULL id is named by the empty string; equal items are all reported; repeated
document rows are treated row by row; no items or no documents give zero hits or an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispersa.llm import text as T

BLOCK_WORDS = 100_000  # of one automaton (about 200 B a word, so some 20 to 40 MB in a worker)

IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[65:91] = IN_WORD[97:123] = True
IN_WORD[128:] = True
# Word bytes lowered, all others a space: bytes.translate and bytes.split then give the words.
_TO_WORDS = bytes(int(T.LOWER[b]) if IN_WORD[b] else 32 for b in range(256))


def item_words(text: str | bytes | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else (text or b"")
    return raw.translate(_TO_WORDS).split()


@dataclass(frozen=True)
class Limits:
    """What ``decontaminate`` takes out."""

    window: int = 10  # words of a match that counts
    min_span: int = 1  # hit runs shorter than this many words stay
    max_coverage: float = 0.5  # a document with a larger share of hit words goes whole


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        number = self.vocabulary
        coded = [(name, [number.setdefault(w, len(number)) for w in words]) for name, words in items if words]
        for _, ids in coded:
            last = 0
            for w in ids:
                last = self._extend(last, w)
        self.shortest = min([window, *(len(ids) for _, ids in coded)]) if coded else 0
        # Items by the state of their windows: of `window` words, or whole for shorter items.
        self.of_window: dict[int, set[str]] = {}
        self.of_whole: dict[int, list[tuple[int, str]]] = {}
        for name, ids in coded:
            state = size = 0
            if len(ids) < window:
                for w in ids:
                    state = self.next[state][w]
                self.of_whole.setdefault(state, []).append((len(ids), name))
                continue
            for w in ids:
                state, size = self.next[state][w], size + 1
                if size >= window:
                    self.of_window.setdefault(self.state_of(state, window), set()).add(name)
        self._shorts: dict[int, list[tuple[int, str]]] = {}

    def _state(self, length: int, link: int, out: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(out)
        return len(self.length) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """A copy of ``q`` for the strings that reach it through ``p``."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:  # the string is already there, from this or an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def state_of(self, state: int, size: int) -> int:
        """State of the last ``size`` words of a string in ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def shorts(self, state: int) -> list[tuple[int, str]]:
        """Short items among the suffixes of the state's strings."""
        found = self._shorts.get(state)
        if found is None:
            found, s = [], state
            while s > 0:
                found += self.of_whole.get(s, [])
                s = self.link[s]
            self._shorts[state] = found
        return found

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches (start, end) of ``words``, possibly overlapping, and the items that occur."""
        if not self.shortest or len(words) < self.shortest:
            return [], set()
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        known = np.zeros(len(ids) + 2, np.int8)
        known[1:-1] = ids >= 0
        edge = np.flatnonzero(np.diff(known))
        hits: list[tuple[int, int]] = []
        items: set[str] = set()
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if hi - lo >= self.shortest:
                self._stream(ids[lo:hi].tolist(), lo, hits, items)
        return hits, items

    def _stream(self, ids: list[int], at: int, hits: list[tuple[int, int]], items: set[str]) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = size = 0
        for i, w in enumerate(ids, at + 1):
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = nxt[state].get(w)
            if to is None:
                continue
            state, size = to, size + 1
            if size >= window:
                hits.append((i - size, i))
                items |= self.of_window[self.state_of(state, window)]
            if self.of_whole:
                for n, name in self.shorts(state):
                    if n <= size:
                        hits.append((i - n, i))
                        items.add(name)


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(hits):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> list[list[tuple[str, str]]]:
    """The items in blocks of at most ``BLOCK_WORDS`` words (or one longer item)."""
    blocks: list[list[tuple[str, str]]] = []
    size = BLOCK_WORDS
    for row in items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        n = len(item_words(row.t))
        if n == 0:
            continue
        if size + n > BLOCK_WORDS:
            blocks.append([])
            size = 0
        blocks[-1].append((row.i or "", row.t))
        size += n
    return blocks


def _mark(docs: DataFrame, text_col: str, block: list[tuple[str, str]], window: int, first: bool,
          added: list[str]) -> DataFrame:
    """Adds (or adds to) the last three columns: hits (flat word spans), items and number of words."""
    names = docs.columns
    kept = names if first else names[:-3]
    schema = ", ".join([f"`{n}` {k}" for n, k in docs.dtypes if n in kept]
                       + [f"`{n}` {k}" for n, k in zip(added, ("array<int>", "array<string>", "bigint"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([(i, item_words(t)) for i, t in block], window)
        for batch in batches:
            for part in T.slices(batch.column(names.index(text_col))):
                here = batch.slice(part.first, part.rows)
                raw, b = part.data.tobytes(), part.bounds.tolist()
                old_hits = [None] * part.rows if first else here.column(len(names) - 3).to_pylist()
                old_items = [None] * part.rows if first else here.column(len(names) - 2).to_pylist()
                hits, items, counts = [], [], []
                for r in range(part.rows):
                    words = raw[b[r]: b[r + 1]].translate(_TO_WORDS).split()
                    h, found = automaton.scan(words)
                    if old_hits[r]:
                        h += list(zip(old_hits[r][::2], old_hits[r][1::2]))
                    hits.append([x for span in _merged(h) for x in span])
                    items.append(sorted(found.union(old_items[r] or ())))
                    counts.append(len(words))
                yield pa.RecordBatch.from_arrays(
                    [*here.columns[: len(kept)], pa.array(hits, pa.list_(pa.int32())),
                     pa.array(items, pa.list_(pa.string())), pa.array(counts, pa.int64())],
                    [*kept, *added])

    return docs.mapInArrow(run, schema)


def mark_matches(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = 10) -> DataFrame:
    """``docs`` with three more columns at the end: ``_hits`` (start, end, start, end, ... of hit word runs),
    ``_items`` (ids of occurring items, sorted as strings) and ``_n_words``; underscores are put before a
    name that is taken."""
    added = ["_hits", "_items", "_n_words"]
    while set(added) & set(docs.columns):
        added = ["_" + n for n in added]
    blocks = item_blocks(items, item_id, item_text) or [[]]
    for k, block in enumerate(blocks):
        docs = _mark(docs, text_col, block, window, k == 0, added)
    return docs


def match_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """One row per document row: words, hit words, occurring items and their digest."""
    marked = mark_matches(docs.select(F.col(id_col), F.col(text_col)), items, text_col, item_id, item_text, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, items = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            n_hit = [sum(h[1::2]) - sum(h[::2]) for h in hits]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(n_hit, pa.int64()),
                 pa.array([len(x) for x in items], pa.int64()),
                 pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                 pa.array([n > 0 for n in n_hit], pa.bool_())],
                [id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    kind = dict(docs.dtypes)[id_col]
    return marked.select(id_col, "_hits", "_items", "_n_words").mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with all its columns: hit runs of ``min_span`` words or more are cut out of the text (from
    the first to the last byte of the run), and documents with more than ``max_coverage`` of their words
    hit are left out. Clean texts are returned unchanged."""
    names = docs.columns
    marked = mark_matches(docs, items, text_col, item_id, item_text, limits.window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for batch in batches:
            hits = batch.column(len(names)).to_pylist()
            counts = batch.column(len(names) + 2).to_pylist()
            share = [(sum(h[1::2]) - sum(h[::2])) / max(1, n) for h, n in zip(hits, counts)]
            texts = batch.column(at)
            if any(hits):
                texts = pa.array([_cut(t, h, limits.min_span) if h else t for t, h in zip(texts.to_pylist(), hits)],
                                 pa.string())
            cols = list(batch.columns[: len(names)])
            cols[at] = texts
            yield pa.RecordBatch.from_arrays(cols, names).filter(
                pa.array([s <= limits.max_coverage for s in share], pa.bool_()))

    return marked.mapInArrow(run, docs.schema)


def _cut(text: str, hits: list[int], min_span: int) -> str:
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = T.spans(data, np.array([0, len(data)]), IN_WORD[data])
    out, at = [], 0
    for lo, hi in zip(hits[::2], hits[1::2]):
        if hi - lo >= min_span:
            out.append(data[at: starts[lo]].tobytes())
            at = int(ends[hi - 1])
    return b"".join([*out, data[at:].tobytes()]).decode()
