"""Chat formatting: conversations cut into training windows under a token budget.

Template: a turn is written as ``### <role>: <text></turn>`` and a line break. Inside texts and roles a
backslash is put before every backslash and into every control string (``##\\#``, ``<\\/turn>``; in roles also
``:\\ ``), so no mark can occur there and dropping the backslashes gives the text back.

Windows: prefix sums of the turns' tokens choose turn-aligned spans. A window holds the conversation's system
turn (its first turn, if that has the role ``system``), then repeated history (the latest earlier turns within
``history`` tokens), then as many new turns as fit the ``budget``; a turn that is larger than the budget makes a
window of its own. Repeated turns come first and are masked: ``loss`` lists the spans (code points) of the
assistant texts among the new turns, so each text is a target once.

Scale: turns are dealt by conversation and segment (``SEGMENT`` turn numbers), sorted, and streamed through an
Arrow task that holds one window and its history, so a conversation of any length is spread over many tasks.
Windows do not reach over a segment's border, a rule of the format and not of the cluster; the later segments
get the system turn by a join that touches long conversations only. Rows that share one turn number of one
conversation stay together, but are streamed, not collected.

Defined results: NULL text or role is empty; turns go by number, NULL first, then role and text; repeated rows
are turns of their own; rows with a NULL conversation id form one conversation; an empty table gives no
windows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispersa.llm.shared import written

END = "</turn>\n"
CONTROL = re.compile(r"\\|(?<=##)#|(?<=<)/(?=turn>)")
IN_ROLE = re.compile(r"\\|(?<=##)#|(?<=<)/(?=turn>)|(?<=:) ")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEGMENT = 1024              # turn numbers of a segment
BUDGET, HISTORY = 1024, 256  # tokens of a window, and of the history in it
FEW = 1 << 16               # ids of long conversations that are broadcast (0.5 MB); more are joined by a shuffle
OUT_BYTES = 1 << 20         # text that a task holds before it hands a batch on


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m.group(), text)


def escape_role(role: str) -> str:
    return IN_ROLE.sub(lambda m: "\\" + m.group(), role)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def count_words(piece: str) -> int:
    """Default measure of a formatted turn: its words."""
    return len(WORD.findall(piece))


def turns_of(text: str) -> list[tuple[str, str]]:
    """``(role, text)`` of the turns of a formatted window, as they were before escaping."""
    out = []
    for piece in text.split(END)[:-1]:
        role, body = piece[4:].split(": ", 1)
        out.append((unescape(role), unescape(body)))
    return out


class _Windows:
    """Windows of one segment, fed turn by turn. Keeps the open window and the turns that can be history."""

    def __init__(self, key: tuple, budget: int, history: int, count):
        self.key, self.budget, self.history, self.count = key, budget, history, count
        self.system: tuple[str, int] | None = None
        self.repeat_system = False      # the system turn is not among the open window's new turns
        self.past: list[str] = []       # earlier turns that can be history, and prefix sums of their tokens
        self.sums = [0]
        self.new: list[tuple[str, int, int, int]] = []  # piece, tokens, span of its target (or -1)
        self.room, self.number = 0, 0

    def head(self, role: str, text: str) -> None:
        piece = f"### {escape_role(role)}: {escape(text)}{END}"
        self.system, self.repeat_system = (piece, self.count(piece)), True

    def turn(self, role: str, text: str, first: bool) -> Iterator[tuple]:
        header = f"### {escape_role(role)}: "
        body = escape(text)
        piece = f"{header}{body}{END}"
        tokens = self.count(piece)
        if self.new and tokens > self.room:
            yield self.close()
        if not self.new:
            self.room = self.budget - (self.system[1] if self.repeat_system else 0)
            share = max(0, min(self.history, self.room - tokens))
            keep = bisect_left(self.sums, self.sums[-1] - share)  # the earliest turn from which all fits the share
            self.past, self.sums = self.past[keep:], self.sums[keep:]
            self.room -= self.sums[-1] - self.sums[0]
        self.room -= tokens
        target = (len(header), len(header) + len(body)) if role == "assistant" else (-1, -1)
        self.new.append((piece, tokens, *target))
        if first and role == "system" and self.system is None:
            self.system = (piece, tokens)

    def close(self) -> tuple:
        lead = ([self.system[0]] if self.repeat_system else []) + self.past
        at = sum(map(len, lead))
        spans = []
        for piece, _, lo, hi in self.new:
            if lo >= 0:
                spans.append((at + lo, at + hi))
            at += len(piece)
        row = (*self.key, self.number, "".join(lead + [p for p, *_ in self.new]), len(lead), len(self.new), spans)
        for piece, tokens, *_ in self.new:
            if self.system is not None and piece is self.system[0]:
                continue  # retained as the system turn, not as history
            self.past.append(piece)
            self.sums.append(self.sums[-1] + tokens)
        keep = bisect_left(self.sums, self.sums[-1] - self.history)
        self.past, self.sums = self.past[keep:], self.sums[keep:]
        self.repeat_system = self.system is not None
        self.new = []
        self.number += 1
        return row


_SPANS = "loss array<struct<start:int,end:int>>"


def _columns(rows: list[tuple]) -> pa.RecordBatch:
    c = list(zip(*rows))
    spans = pa.array([[{"start": a, "end": b} for a, b in s] for s in c[7]],
                     pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
    return pa.RecordBatch.from_arrays(
        [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.bool_()), pa.array(c[3], pa.int64()),
         pa.array(c[4], pa.string()), pa.array(c[5], pa.int32()), pa.array(c[6], pa.int32()), spans],
        names=["conv_id", "segment", "long", "window", "text", "n_repeated", "n_new", "loss"])


def _format(budget: int, history: int, count):
    """Arrow task over turns sorted by conversation, segment and place."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        here: _Windows | None = None
        for batch in batches:
            for conv, segment, long, first, head, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                key = (conv, segment, long)
                if here is None or here.key != key:
                    if here is not None and here.new:
                        yield here.close()
                    here, opening = _Windows(key, budget, history, count), True
                if head:
                    here.head(role, text)
                    continue
                yield from here.turn(role, text, first and opening)
                opening = False
        if here is not None and here.new:
            yield here.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in windows(batches):
            held.append(row)
            size += len(row[4])
            if size >= OUT_BYTES:
                yield _columns(held)
                held, size = [], 0
        if held:
            yield _columns(held)

    return run


_PLACE = ["conv_id", "segment", "turn", "role", "text"]


def _segment() -> Column:
    """Segment of a turn number; NULL numbers stand before all."""
    return F.coalesce(F.floor(F.col("turn") / F.lit(SEGMENT)), F.lit(-(1 << 62))).cast("bigint")


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, count=count_words) -> DataFrame:
    """``(conv_id, segment, long, window, text, n_repeated, n_new, loss)`` of ``(conv_id, turn, role, text)``.

    ``window`` numbers the windows of a segment; the first ``n_repeated`` turns of ``text`` are repeats (system
    turn, history), then come ``n_new`` turns; ``loss`` are the targets' spans; ``long`` says that the
    conversation has several segments. ``count`` measures a formatted turn in tokens (words by default; any
    picklable function, such as a tokenizer's).
    """
    if budget < 1 or history < 0:
        raise ValueError("budget must be >= 1 and history >= 0")
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.withColumn("segment", _segment())
    reach = turns.groupBy("conv_id").agg(F.min("segment").alias("_first"), F.max("segment").alias("_last"))
    # The conversations of several segments: ids only, written once as they are used up to three times.
    several = written(reach.where("_first < _last").select(F.col("conv_id").alias("_conv"), "_first"), "long")
    n = several.count()
    rows = turns.withColumns({"long": F.lit(False), "first": F.lit(True), "head": F.lit(False)})
    if n:
        several = F.broadcast(several) if n <= FEW else several
        joined = turns.join(several, turns["conv_id"].eqNullSafe(several["_conv"]), "left")
        own = joined.select(*turns.columns, F.col("_first").isNotNull().alias("long"),
                            (F.col("_first").isNull() | (F.col("segment") == F.col("_first"))).alias("first"),
                            F.lit(False).alias("head"))
        place = F.struct(F.col("turn").isNotNull(), "turn", "role", "text")
        opening = joined.where(F.col("segment") == F.col("_first")).groupBy(F.col("conv_id").alias("_of")).agg(
            F.min(place).alias("_t")).where(F.col("_t.role") == "system").select("_of", "_t.role", "_t.text")
        others = own.where("NOT first").select("conv_id", "segment").distinct()
        heads = others.join(opening, others["conv_id"].eqNullSafe(opening["_of"])).select(
            "conv_id", F.lit(None).cast("bigint").alias("turn"), "role", "text", "segment", F.lit(True).alias("long"),
            F.lit(False).alias("first"), F.lit(True).alias("head"))
        rows = own.unionByName(heads)
    dealt = rows.repartition("conv_id", "segment").sortWithinPartitions(
        "conv_id", "segment", F.col("head").desc(), F.asc_nulls_first("turn"), "role", "text")
    return dealt.select("conv_id", "segment", "long", "first", "head", "role", "text").mapInArrow(
        _format(budget, history, count),
        f"conv_id bigint, segment bigint, long boolean, window bigint, text string, n_repeated int, n_new int, {_SPANS}")


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.formatted = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def window(self, text: str, repeated: int, loss: list[dict]) -> None:
        new = turns_of(text)[repeated:]
        self.turns += len(new)
        self.formatted += len(text)
        for role, body in new:
            self.all.update(f"{role}\n{body}\n".encode())
        for span in loss:
            target = unescape(text[span["start"]: span["end"]])
            self.chars += len(target)
            self.loss.update(target.encode())

    def row(self) -> tuple:
        return (self.conv, self.turns, self.all.hexdigest(), self.chars, self.loss.hexdigest(), self.formatted)


_DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
            "formatted_chars bigint")
_OPEN = "segment bigint, window bigint, text string, n_repeated int, loss array<struct<start:int,end:int>>"


def _read_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose windows stand together; windows of the others are handed on."""
    names = [f.split()[0] for f in f"{_DIGESTS}, {_OPEN}".replace("array<struct<start:int,end:int>>", "x").split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
             pa.int32(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
    here: _Digest | None = None
    for batch in batches:
        out = []
        cols = [batch.column(n).to_pylist() for n in ("conv_id", "segment", "long", "window", "text", "n_repeated", "loss")]
        for conv, segment, long, window, text, repeated, loss in zip(*cols):
            if here is not None and (window == 0 or long):
                out.append((*here.row(), *(None,) * 5))
                here = None
            if long:
                out.append((conv, *(None,) * 5, segment, window, text, repeated, loss))
                continue
            here = here or _Digest(conv)
            here.window(text, repeated, loss)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
    if here is not None:
        row = (*here.row(), *(None,) * 5)
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def _read_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished digests pass; windows sorted by conversation, segment and number are read one after another."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    here: _Digest | None = None
    for batch in batches:
        out = []
        cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for row in zip(*cols):
            if here is not None and (row[2] is not None or row[0] != here.conv):
                out.append(here.row())
                here = None
            if row[2] is not None:
                out.append(row[:6])
                continue
            here = here or _Digest(row[0])
            here.window(row[8], row[9], row[10])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
    if here is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(here.row(), kinds)], names=names)


def read_back(windows: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` from the windows of
    ``format_windows`` (its own rows, not reordered).

    A conversation of one segment is read where its windows were made. The windows of the others are dealt by
    conversation and streamed in order, as a SHA-256 over a whole conversation is a chain: one task reads a long
    conversation's windows, one at a time.
    """
    read = windows.mapInArrow(_read_short, f"{_DIGESTS}, {_OPEN}")
    dealt = read.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turns_sha256").isNull(), "segment", "window")
    return dealt.mapInArrow(_read_long, _DIGESTS)
