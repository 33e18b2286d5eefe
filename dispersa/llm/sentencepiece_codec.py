"""SentencePiece (BPE with byte fallback) encoding by a prefix table, and decoding.

Encoding never runs merges. For every prefix of a chunk there is exactly one token that can end it in the
BPE segmentation of that prefix. The table stores this last token: an Aho-Corasick automaton over the
pieces lists the tokens that end at a position, and of these the one counts whose join with the last
token before it survives the pair test (BPE would not merge across the join at any earlier step). The
ids of the chunk are then read backwards from its last prefix.

A text is cut into chunks where no piece can reach across: before a run of spaces that follows other
characters, around line feeds, and where marks (ASCII punctuation and what shares a piece with it) meet other
characters, unless the model has pieces with letters or digits beside marks. Chunks repeat, so each worker keeps recent ones; the cache only saves
work. Runs of spaces are the one kind of piece with equal scores; BPE grows them from the left, which the
run rule below reproduces.

Defined results: NULL and empty texts have no tokens and decode to the empty text; a character outside
the vocabulary becomes its UTF-8 byte tokens; rows are independent, so ties, repeated rows, repeated ids
and empty tables need no rule. Narrow (no shuffle); memory is bounded by a batch and the cache limit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from operator import itemgetter

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispersa.llm import text as T
from dispersa.llm.shared import RecentCache, per_worker

SPACE = "▁"
MARKS = {chr(i) for i in range(33, 127) if not chr(i).isalnum()}
CACHED_CHUNKS = 150_000  # of each of two generations in a worker: some 80 MB
CACHED_PAIRS = 300_000  # tested joins of two tokens: some 40 MB


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.surface: list[bytes] = [b""] * size
        self.byte_id = [0] * 256
        pieces: dict[str, int] = {}
        self.space_runs: dict[int, int] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.surface[i] = bytes([value])
            elif model.is_control(i) or model.is_unknown(i):
                self.surface[i] = " ⁇ ".encode() if model.is_unknown(i) else b""
            else:
                self.surface[i] = piece.replace(SPACE, " ").encode()
                if len(piece) > 1 and not piece.strip(SPACE):
                    self.space_runs[len(piece)] = i
                else:
                    pieces[piece] = i
                    if SPACE in piece[1:] or "\n" in piece:
                        raise ValueError(f"a piece reaches over a chunk border: {piece!r}")
        self.cut = _chunk_pattern(pieces)
        # Merge order: the highest score first. Single characters are never the result of a merge.
        by_score = sorted((p for p in pieces if len(p) > 1), key=lambda p: -model.get_score(pieces[p]))
        self.rank = {pieces[p]: r for r, p in enumerate(by_score)}
        self.ids = pieces
        self.text = {i: p for p, i in pieces.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self._pairs: dict[int, bool] = {}
        alphabet = [p for p in pieces if len(p) == 1]
        self.matcher = ahocorasick.Automaton()
        for p in alphabet:
            self.matcher.add_word(p, (1, pieces[p]))
        for p in by_score:  # in merge order, so a token's parts are known before it
            split = self._split(p)
            if split:
                self.parts[pieces[p]] = split
                self.matcher.add_word(p, (len(p), pieces[p]))
        self.matcher.make_automaton()

    def _split(self, piece: str) -> tuple[int, int] | None:
        """The two tokens whose merge makes the piece; None if merging never makes it."""
        for k in range(1, len(piece)):
            left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
            if left is None or right is None:
                continue
            if (k > 1 and left not in self.parts) or (len(piece) - k > 1 and right not in self.parts):
                continue
            if self.joins(left, right, self.rank[self.ids[piece]]):
                return left, right
        return None

    def joins(self, left: int, right: int, making: int | None = None) -> bool:
        """True if BPE, run over the two tokens' text, leaves the border between them alone (up to the
        merge of rank ``making``, if given). Undoes the merges of both sides from the latest on and looks
        whether one across the border would have come before the merge that hides it."""
        rank, parts = self.rank, self.parts
        limit = making if making is not None else 1 << 60
        while True:
            across = self.ids.get(self.text[left] + self.text[right])
            if across is not None:
                r = rank.get(across)
                if r is not None and r < limit:
                    return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            # The later merge is undone first. Equal ones (the same token on both sides) happen from
            # left to right, so the right one is the later.
            if a > b:
                limit, left = a, parts[left][1]
            else:
                # A merge across the border of the same rank would stand to the left of this one.
                limit, right = b + 1, parts[right][0]

    def _compatible(self, pair: int) -> bool:
        if len(self._pairs) > CACHED_PAIRS:
            self._pairs.clear()
        got = self._pairs[pair] = self.joins(pair >> 32, pair & 0xFFFFFFFF)
        return got

    def _word(self, chunk: str) -> list[int]:
        """Ids of a chunk with at most one space sign, at its start."""
        n = len(chunk)
        last = [-1] * (n + 1)  # the last token of each prefix; -1: it ends in a character outside
        size = [1] * (n + 1)
        known = self._pairs.get
        for end, (length, token) in self.matcher.iter(chunk):
            end += 1
            if last[end] >= 0:
                continue  # found: it is the only one
            before = last[end - length] if end > length else -1
            if before >= 0:
                pair = before << 32 | token
                fits = known(pair)
                if not (self._compatible(pair) if fits is None else fits):
                    continue
            last[end], size[end] = token, length
        out: list[int] = []
        i = n
        while i > 0:
            if last[i] >= 0:
                out.append(last[i])
            else:
                out += [self.byte_id[b] for b in reversed(chunk[i - 1].encode())]
            i -= size[i]
        out.reverse()
        return out

    def _spaces(self, n: int) -> list[int]:
        """A run of n space signs: the longest run piece again and again, then the rest."""
        longest = max(self.space_runs, default=1)
        single = self.ids.get(SPACE)
        out: list[int] = []
        while n > 0:
            k = min(n, longest)
            while k > 1 and k not in self.space_runs:
                k -= 1
            out += [self.space_runs[k]] if k > 1 else [single] if single is not None else [
                self.byte_id[b] for b in SPACE.encode()]
            n -= k
        return out

    def chunk_ids(self, chunk: str) -> list[int]:
        chunk = chunk.replace(" ", SPACE)
        run = len(chunk) - len(chunk.lstrip(SPACE))
        if run == len(chunk):
            return self._spaces(run)
        if run <= 1:
            return self._word(chunk)
        ids = self._word(chunk[run - 1:])
        # The last space sign belongs to the word if its first token is longer than the sign.
        if ids[0] == self.ids.get(SPACE):
            return self._spaces(run) + ids[1:]
        return self._spaces(run - 1) + ids

    def chunks(self, text: str) -> list[str]:
        """Chunks with plain spaces; the space sign in a text is a space as well."""
        return self.cut.findall(" " + text.replace(SPACE, " ")) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for c in self.chunks(text) for i in self.chunk_ids(c)]

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.surface.__getitem__, ids))
        if ids and self.surface[ids[0]][:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")

    def entry(self, chunk: str) -> tuple[int, str, bytes]:
        """Number of ids, ids as text, their surfaces."""
        ids = self.chunk_ids(chunk)
        return len(ids), ",".join(map(str, ids)), b"".join(map(self.surface.__getitem__, ids))


def _chunk_pattern(pieces: Iterable[str]) -> re.Pattern:
    """Cuts texts into chunks. Marks are closed under sharing a piece, so no merge crosses a border of theirs."""
    marks, groups = set(MARKS), [set(p) - {SPACE} for p in pieces]
    while more := set().union(*(g for g in groups if g & marks)) - marks:
        marks |= more
    if any(c.isalnum() and c.isascii() for c in marks):  # nothing is left to cut
        return re.compile(" *[^ \n]+| +|\n")
    own = "".join(map(re.escape, sorted(marks)))
    return re.compile(f" *[^ \n{own}]+| *[{own}]+| +|\n")


def _entries(model_path: str) -> tuple[Codec, RecentCache]:
    return per_worker(("sentencepiece", model_path), lambda: (Codec(model_path), RecentCache(CACHED_CHUNKS)))


def _batches(batches: Iterator[pa.RecordBatch], model_path: str, at: int):
    """(rows of the batch, entries of each row's chunks) for slices of bounded size."""
    codec, cache = _entries(model_path)
    make = lambda missing: map(codec.entry, missing)
    for batch in batches:
        for part in T.slices(batch.column(at), T.TEXT_BYTES):
            raw, b = part.data.tobytes(), part.bounds.tolist()
            yield batch.slice(part.first, part.rows), (
                cache.get_all(codec.chunks(raw[b[r]: b[r + 1]].decode()), make) for r in range(part.rows))


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with all its columns and the token ids of the text as ``array<int>`` (replacing a column of
    that name)."""
    names = docs.columns
    keep = [n for n in names if n != ids_col]
    schema = ", ".join([f"`{n}` {k}" for n, k in docs.dtypes if n != ids_col] + [f"`{ids_col}` array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for here, rows in _batches(batches, model_path, names.index(text_col)):
            ids = [[int(i) for e in entries for i in e[1].split(",")] for entries in rows]
            yield pa.RecordBatch.from_arrays(
                [here.column(names.index(n)) for n in keep] + [pa.array(ids, pa.list_(pa.int32()))], [*keep, ids_col])

    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``tokens`` with the decoded text (replacing a column of that name). NULL ids give an empty text."""
    names = tokens.columns
    keep = [n for n in names if n != text_col]
    schema = ", ".join([f"`{n}` {k}" for n, k in tokens.dtypes if n != text_col] + [f"`{text_col}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, _ = _entries(model_path)
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in batch.column(names.index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index(n)) for n in keep] + [pa.array(texts, pa.string())], [*keep, text_col])

    return tokens.mapInArrow(run, schema)


_COUNT, _TEXT, _SURFACE = itemgetter(0), itemgetter(1), itemgetter(2)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the text decoded from them."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for here, rows in _batches(batches, model_path, 1):
            counts, ids_sha, text_sha = [], [], []
            for entries in rows:
                counts.append(sum(map(_COUNT, entries)))
                ids_sha.append(hashlib.sha256(",".join(map(_TEXT, entries)).encode()).hexdigest())
                surface = b"".join(map(_SURFACE, entries))
                if surface[:1] == b" ":  # the dummy prefix
                    surface = surface[1:]
                text_sha.append(hashlib.sha256(surface).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [here.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
