"""Quality rules, line first: every line is judged by punctuation, navigation and boilerplate rules,
failing lines are removed, and a document that loses too much of its text is rejected.

Input: any columns with an id and a text column (names are parameters); extra columns are ignored by
``judge_lines`` and kept by ``clean_documents``. One pass over the rows, no shuffle.

Defined results: NULL or empty text has no words, fails the base rules and is not kept; repeated rows
are judged row by row (the same text always gets the same verdict); an empty table gives an empty table;
a text of any length is judged whole (memory is a small multiple of the longest single text).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispersa.llm import text as T
from dispersa.llm.shared import release_worker

# Characters that count as symbols, ends of a sentence, separators of a navigation line
# and phrases of page furniture.
SYMBOLS = b"#*$%&|<>"
SENTENCE_ENDS = b".!?\"')"
SENTENCE_ENDS_3 = ("…", "”", "’", "。", "！", "？")
SEPARATORS = b"|>/-"
BOILERPLATE = ("lorem ipsum", "javascript", "cookie policy", "privacy policy", "terms of use", "terms of service",
               "all rights reserved", "sign in", "log in", "read more", "click here", "subscribe to our newsletter",
               "share this", "licensed under the")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; shares are of the line's words or letters."""

    min_words: int = 50  # of a document
    max_repeat_share: float = 0.5  # of words in repeated 3-word windows
    max_line_symbols: float = 0.1  # symbol characters per word character
    min_separators: int = 2  # separators that stand alone in a navigation line
    max_upper_share: float = 0.6  # of a line's letters
    min_letters: int = 10  # for the upper-case rule
    min_cut_words: int = 20  # a line this long with a sentence end inside may lack one at its end
    max_lost_share: float = 0.3  # of a document's words, in failing lines


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


ALNUM = _table(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")  # no border of a phrase


class _Sums:
    """Sums of a 0/1 array over spans."""

    def __init__(self, flags: np.ndarray):
        self.total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=self.total[1:])

    def over(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.total[end] - self.total[start]


def _not_first(keys: np.ndarray) -> np.ndarray:
    """True where an equal key stands earlier."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return out


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where the key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order] = same[:-1] | same[1:]
    return out


def _in_row(names: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return T.mix(names ^ T.mix(rows.astype(np.uint64) + T.U64(1)))


def _judge(part: T.Slice, rules: Rules) -> dict[str, np.ndarray]:
    data, bounds, n_rows = part.data, part.bounds, part.rows
    top, low = bounds[:-1], bounds[1:]
    starts, ends, before = T.words(data, bounds)
    space = T.SPACE[data]
    chars = _Sums(~space & ((data & 0xC0) != 0x80))
    symbol = _Sums(_table(SYMBOLS)[data])
    prints = T.Fingerprints(data)

    # Words in 3-word windows that occur twice in their row.
    word_rows = np.repeat(np.arange(n_rows), np.diff(before))
    names = prints.of(starts, ends)
    hit = np.zeros(len(names) + 1, np.int64)
    if len(names) >= 3:
        ok = word_rows[:-2] == word_rows[2:]
        three = names[:-2] * T.U64(3) + T.mix(names[1:-1]) * T.U64(5) + T.mix(names[2:] + T.U64(7))
        at = np.flatnonzero(ok)[_repeated(_in_row(three[ok], word_rows[:-2][ok]))]
        np.add.at(hit, at, 1)
        np.add.at(hit, at + 3, -1)
    repeat = _Sums(np.cumsum(hit)[:-1] > 0).over(before[:-1], before[1:])

    # Lines with a word.
    l_start, l_end, _ = T.spans(data, bounds, data != 10)
    first, stop = np.searchsorted(starts, l_start), np.searchsorted(starts, l_end)
    with_word = stop > first
    l_start, l_end, first, stop = l_start[with_word], l_end[with_word], first[with_word], stop[with_word]
    l_rows = np.searchsorted(bounds, l_start, "right") - 1
    dup = _not_first(_in_row(prints.of(l_start, l_end), l_rows))

    # Line rules.
    n = stop - first
    close = ends[stop - 1]  # after the line's last word
    last = data[close - 1] if len(close) else np.zeros(0, np.uint8)
    ended = _table(SENTENCE_ENDS)[last]
    for mark in SENTENCE_ENDS_3:
        b = mark.encode()
        at = np.maximum(close - 3, 0)
        ended |= (close >= 3) & (data[at] == b[0]) & (data[np.minimum(at + 1, close - 1)] == b[1]) & (data[close - 1] == b[2])
    sentence = _table(SENTENCE_ENDS)[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    ended |= (n >= rules.min_cut_words) & (_Sums(sentence).over(first, stop) > 0)
    line_chars = chars.over(l_start, l_end)
    noisy = symbol.over(l_start, l_end) > rules.max_line_symbols * line_chars
    alone = (ends - starts == 1) & _table(SEPARATORS)[data[starts]] if len(starts) else np.zeros(0, bool)
    navigation = _Sums(alone).over(first, stop) >= np.maximum(rules.min_separators, 0.2 * n)
    latin = np.zeros(len(data), bool)
    latin[1:] = data[:-1] == 0xC3
    upper = ((data >= 65) & (data <= 90)) | (latin & (data >= 0x80) & (data <= 0x9E) & (data != 0x97))
    lower = ((data >= 97) & (data <= 122)) | (latin & (data >= 0x9F) & (data <= 0xBF) & (data != 0xB7))
    n_upper, n_lower = _Sums(upper).over(l_start, l_end), _Sums(lower).over(l_start, l_end)
    letters = n_upper + n_lower
    shouting = (letters >= rules.min_letters) & (n_upper > rules.max_upper_share * letters)
    furniture = np.zeros(len(l_start), bool)
    for m in re.finditer("|".join(map(re.escape, BOILERPLATE)).encode(), T.LOWER[data].tobytes()):
        k = int(np.searchsorted(l_start, m.start(), "right")) - 1
        if k >= 0 and m.end() <= l_end[k]:  # whole words of the line: "catalog index" is no "log in"
            inner = m.start() > l_start[k] and ALNUM[data[m.start() - 1]] or m.end() < l_end[k] and ALNUM[data[m.end()]]
            furniture[k] |= not inner
    fails = ~ended | noisy | navigation | shouting | furniture | dup

    n_words = np.diff(before)
    per_row = lambda flags: np.bincount(l_rows, weights=flags, minlength=n_rows).astype(np.int64)
    lost = per_row(n * fails)
    base_failed = (n_words < rules.min_words) | (repeat > rules.max_repeat_share * n_words)
    return {
        "n_words": n_words, "word_chars": chars.over(top, low), "n_symbols": symbol.over(top, low),
        "n_dup_lines": per_row(dup), "n_repeat_words": repeat, "base_failed": base_failed,
        "n_lines": per_row(np.ones(len(l_rows))), "n_bad_lines": per_row(fails), "n_lost_words": lost,
        "kept": ~base_failed & (lost <= rules.max_lost_share * n_words),
        "_lines": (l_rows, l_start, l_end, fails),
    }


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bad_lines",
           "n_lost_words")
_FLAGS = ("base_failed", "kept")
VERDICT = ", ".join([f"{c} long" for c in _COUNTS] + [f"{c} boolean" for c in _FLAGS])


def judge_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules(),
                with_text: bool = False) -> DataFrame:
    """One row per input row: the id, the counts of ``VERDICT`` and, on request, ``clean_text``: the
    text without its failing lines (lines without a word stay)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            for part in T.slices(batch.column(1)):
                got = _judge(part, rules)
                cols = [batch.column(0).slice(part.first, part.rows)]
                cols += [pa.array(got[c], pa.int64()) for c in _COUNTS]
                cols += [pa.array(got[c], pa.bool_()) for c in _FLAGS]
                names = [id_col, *_COUNTS, *_FLAGS]
                if with_text:
                    cols.append(pa.array(_without_failing(part, *got["_lines"]), pa.string()))
                    names.append("clean_text")
                yield pa.RecordBatch.from_arrays(cols, names)

    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, {VERDICT}" + (", clean_text string" if with_text else "")
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _without_failing(part: T.Slice, rows: np.ndarray, start: np.ndarray, end: np.ndarray,
                     fails: np.ndarray) -> list[str]:
    out = []
    by_row = np.searchsorted(rows, np.arange(part.rows + 1))
    for r in range(part.rows):
        lo, hi = int(part.bounds[r]), int(part.bounds[r + 1])
        pieces, at = [], lo
        for k in range(by_row[r], by_row[r + 1]):
            if fails[k]:
                pieces.append(part.data[at: start[k]].tobytes())
                at = min(int(end[k]) + 1, hi)  # with its line break
        pieces.append(part.data[at: hi].tobytes())
        out.append(b"".join(pieces).decode())
    return out


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    rules: Rules = Rules()) -> DataFrame:
    """The kept rows with all their columns, the text replaced by its passing lines. Works on rows, not
    ids, so repeated ids are no problem; no shuffle."""
    columns = docs.columns
    fields = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        at = columns.index(text_col)
        for batch in batches:
            for part in T.slices(batch.column(at)):
                got = _judge(part, rules)
                keep = pa.array(got["kept"])
                cols = [c.slice(part.first, part.rows) for c in batch.columns]
                cols[at] = pa.array(_without_failing(part, *got["_lines"]), pa.string())
                yield pa.RecordBatch.from_arrays(cols, columns).filter(keep)

    return docs.mapInArrow(run, fields)
