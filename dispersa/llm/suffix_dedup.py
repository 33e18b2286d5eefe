"""Removal of byte strings of ``length`` bytes that occur more than once in the corpus, and, if ``words`` is
given, of runs of as many words.

Distributed prefix doubling on sampled positions. Sorting the suffixes at every byte of a corpus moves
many times its size, so positions are sampled by content: the start p of a ``length``-byte string is
represented by its anchor, the leftmost smallest hash of a short gram among the first ``window`` starts
after p. The anchor depends on the string alone, so equal strings have equal anchors at equal distance.
All starts of one anchor share the ``core``, the ``length - window + 1`` bytes from the anchor on.

1. Rank the anchors by their first core / 4 bytes and drop those whose rank is unique; then double the
   compared length, until the core is ranked: Spark sorts the distinct pairs (rank, rank of the as many bytes that
   follow), a pair's place in that order is its new rank, and anchors whose pair is unique go.
2. An anchor's ``span`` are all bytes of all its starts' strings. Equal spans: every start is a repeat.
   A span that is unique although its core is not has a border of a repeat inside: the range of starts
   is cut into blocks of ``BLOCK`` and then single starts, and core and span of these are compared again.
   Every range that fails to match by its core is done; one example of each repeated span stays in play
   for the others to match.
3. The ranges found are merged per text and cut out.

Runs of words go the same way over the names of the words in place of bytes: all lengths and places then
count words, and the ranges found become bytes (first word's start to last word's end) when they are merged.
Words are equal byte for byte; the white space between them is free.

Exact copies are one text throughout. Distinct texts are written once, bucketed by key, so the passes over
them need no shuffle of text. No step gathers the members of a rank: counts are partial sums, joined back by rank and
part (first ranks, made in one pass) or in a join that Spark can split where one rank has very many rows.

First ranks are fingerprints (``text.Fingerprints``: two different strings of n bytes agree with a chance of about
(n / 2**31) ** 2); texts are keyed by 60 bits of their MD5, copies are found by the whole MD5.

Defined results: NULL is an empty text; a text shorter than ``length`` and of fewer words than ``words`` is kept
whole; matches never cross
texts; the same string twice in one document counts, overlaps included; repeated rows are copies; repeated
or NULL ids are no problem (rows are never matched by id); an empty table gives no rows; extra columns are
kept by ``remove_repeats`` and ignored by ``repeat_report``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispersa.llm import text as T
from dispersa.llm.shared import new_path, release_worker, written

GRAM = 24
BLOCK = 16


class Shape(NamedTuple):
    length: int
    window: int
    gram: int
    in_words: bool = False  # lengths and places count words, not bytes

    @property
    def core(self) -> int:
        return self.length - self.window + 1

    @property
    def steps(self) -> list[int]:
        """Compared bytes after each round."""
        return sorted({max(1, -(-self.core // 4)), max(1, -(-self.core // 2)), self.core})


def shape(length: int, in_words: bool = False) -> Shape:
    if length < 1:
        raise ValueError("length must be at least 1")
    window = max(1, length * 8 // 25)
    return Shape(length, window, max(1, min(GRAM, length - window + 1)), in_words)


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - (width - size)], keys[width - size:]) if size < width else keys


def anchors(prints: T.Fingerprints, bounds: np.ndarray, s: Shape) -> tuple[np.ndarray, ...]:
    """(row, anchor, lo, hi) of every anchor: its starts are anchor - hi to anchor - lo."""
    empty = np.zeros(0, np.int64)
    sizes = np.diff(bounds) - s.length + 1
    fit = np.flatnonzero(sizes > 0)
    if not len(fit):
        return empty, empty, empty, empty
    grams = prints.hashes(s.gram)
    # The hash above, the place below: the minimum is the leftmost of equal hashes.
    keys = (grams & T.U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_min(keys, s.window) & T.U64(0xFFFFFFFF)).astype(np.int64)
    # The starts of whole strings of a row are top to stop - 1; runs of one anchor end where it changes or a row ends.
    top, stop = bounds[fit], bounds[fit] + sizes[fit]
    cuts = np.unique(np.concatenate([np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, top, stop]))
    owner = np.searchsorted(top, cuts, "right") - 1
    run = np.flatnonzero((owner >= 0) & (cuts < stop[owner]))
    begin, last, a = cuts[run], cuts[run + 1] - 1, anchor[cuts[run]]
    return fit[owner[run]], a, a - last, a - begin


def _names(prints: T.Fingerprints, top: np.ndarray, low: np.ndarray, anchor: np.ndarray, lo: np.ndarray,
           hi: np.ndarray, s: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Names of core and span of the starts at distances lo to hi of the anchor. A span ends where its
    text does; how much is missing is then part of its name. ``top``, ``low``: the text's borders."""
    core = prints.of(anchor - lo, anchor - hi + s.length)
    start, end = np.maximum(anchor - hi, top), np.minimum(anchor - lo + s.length, low)
    lost = (start - (anchor - hi)) * 65537 + (anchor - lo + s.length - end)
    place = T.mix((lo * 4099 + hi + 1).astype(np.uint64))
    return T.mix(core ^ place), T.mix(prints.of(start, end) ^ place ^ T.mix(lost.astype(np.uint64)))


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _key(text_col: str) -> tuple[Column, Column]:
    """MD5 of a text, and its first 60 bits."""
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    return digest, F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _size(text_col: str) -> Column:
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")


def _long(text_col: str, length: int, words: int | None) -> Column:
    """Whether a text has ``length`` bytes or ``words`` words."""
    if words is None:
        return _size(text_col) >= length
    n_words = F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"))
    return (_size(text_col) >= length) | ((_size(text_col) >= 2 * words - 1) & (n_words >= words))


def distinct_texts(docs: DataFrame, text_col: str, length: int, words: int | None) -> DataFrame:
    """The distinct texts of at least ``length`` bytes or ``words`` words as a table (k, digest, text) bucketed by k."""
    spark = docs.sparkSession
    digest, key = _key(text_col)

    def once_per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A text that fills a third of the rows leaves a task once, so its copies load no partition.
        seen: set[str] = set()
        for batch in batches:
            keep = []
            for d in batch.column(1).to_pylist():
                keep.append(d not in seen)
                seen.add(d)
            yield batch.filter(pa.array(keep, pa.bool_()))

    long_texts = docs.filter(_long(text_col, length, words)).select(key.alias("k"), digest.alias("digest"), F.col(text_col).alias("text"))
    once = long_texts.mapInArrow(once_per_task, "k long, digest string, text string")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"dispersa_texts_{uuid.uuid4().hex[:12]}"
    (once.repartition(parts, "k").dropDuplicates(["k", "digest"])
     .write.bucketBy(parts, "k").option("path", new_path(spark, "distinct-texts")).saveAsTable(name))
    return spark.table(name)


def _repeated(rows: DataFrame) -> DataFrame:
    """The rows (k, pos) of ``rows (k, pos, rank)`` whose rank occurs twice or more in its first 60 bits. The rows are
    made and shuffled once: the counts are taken from the exchange that the join reads. Four bits of the text's key in
    place of the last ones deal a rank's rows to 16 parts, so a rank that very many rows have is no one task's work."""
    dealt = (rows.select("k", "pos", F.expr("rank & -16L | k & 15L").alias("part")).filter("part IS NOT NULL")
             .repartition("part"))
    # Both readers of the exchange need the same columns, or Spark makes it twice: so k and pos are counted, not 1.
    more = dealt.groupBy(F.shiftright("part", 4).alias("name")).agg(
        F.expr("count(k, pos)").alias("n"), F.bit_or(F.expr("shiftleft(1, cast(part & 15L AS int))")).alias("parts")).filter("n > 1")
    parts = F.array(*[F.when(F.col("parts").bitwiseAND(1 << i) != 0, F.expr(f"shiftleft(name, 4) | {i}L")) for i in range(16)])
    return dealt.join(more.select(F.explode(parts).alias("part")).filter("part IS NOT NULL"), "part").select("k", "pos")


def _reranked(rows: DataFrame, follow: Column) -> DataFrame:
    """A round of doubling: the rows whose pair of ``rank`` and ``follow`` occurs twice or more, with the pair's
    place among the sorted pairs as their rank (rising, not dense)."""
    rows = rows.withColumn("next", follow)
    order = rows.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy("rank", "next")
    order = order.select("rank", "next", F.monotonically_increasing_id().alias("place"))
    joined = rows.join(order.repartition("rank", "next"), ["rank", "next"])
    return joined.drop("rank", "next").withColumnRenamed("place", "rank")


def _word_slice(part: T.Slice) -> T.Slice:
    """The slice with the names of its words in place of its bytes."""
    starts, ends, before = T.words(part.data, part.bounds)
    return T.Slice(part.first, T.Fingerprints(part.data).of(starts, ends), before)


def _scan(texts: DataFrame, make: Callable, s: Shape, extra: str | None, schema: str) -> DataFrame:
    """``make(key, slice, lists)`` over the texts gives Arrow columns; ``extra``: an array column."""

    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            for part in T.slices(batch.column(1)):
                keys = batch.column(0).slice(part.first, part.rows)
                lists = batch.column(2).slice(part.first, part.rows) if extra else None
                yield pa.RecordBatch.from_arrays(make(keys, _word_slice(part) if s.in_words else part, lists), names)

    return texts.select("k", "text", *([extra] if extra else [])).mapInArrow(run, schema)


def _first_ranks(s: Shape) -> Callable:
    def make(keys: pa.Array, part: T.Slice, _lists) -> list[pa.Array]:
        prints = T.Fingerprints(part.data)
        rows, anchor, _, _ = anchors(prints, part.bounds, s)
        rank = prints.of(anchor, anchor + s.steps[0])
        return [keys.take(pa.array(rows)), pa.array((anchor - part.bounds[rows]).astype(np.int32)), _i64(rank)]

    return make


def _anchor_rows(s: Shape) -> Callable:
    """Ranks of the following bytes for each round, and the span, of the anchors in the lists."""

    def make(keys: pa.Array, part: T.Slice, lists: pa.Array) -> list[pa.Array]:
        prints = T.Fingerprints(part.data)
        rows, anchor, lo, hi = anchors(prints, part.bounds, s)
        row, values = _flat(lists)
        want = values.to_numpy() + part.bounds[row]  # places in the slice are unique
        keep = np.isin(anchor, want)
        rows, anchor, lo, hi = rows[keep], anchor[keep], lo[keep], hi[keep]
        zero = np.zeros_like(lo)
        _, span = _names(prints, part.bounds[rows], part.bounds[rows + 1], anchor, zero, zero + s.window - 1, s)
        ranks = [prints.of(anchor, anchor + s.steps[0])]
        ranks += [prints.of(anchor + a, anchor + b) for a, b in zip(s.steps, s.steps[1:])]
        follow = pa.FixedSizeListArray.from_arrays(_i64(np.stack(ranks, axis=1).ravel()), len(ranks))
        return [keys.take(pa.array(rows)), pa.array((anchor - part.bounds[rows]).astype(np.int32)),
                pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
                follow.cast(pa.list_(pa.int64())), _i64(span)]

    return make


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _block_rows(s: Shape, block: int) -> Callable:
    """Core and span of the blocks of ``block`` starts in the listed ranges (pos, lo, hi, sure)."""

    def make(keys: pa.Array, part: T.Slice, lists: pa.Array) -> list[pa.Array]:
        prints = T.Fingerprints(part.data)
        row, values = _flat(lists)
        pos, lo, hi = (values.field(n).to_numpy().astype(np.int64) for n in ("pos", "lo", "hi"))
        sure = values.field("sure").to_numpy(zero_copy_only=False)
        n = hi // block - lo // block + 1
        unit = np.repeat(np.arange(len(pos)), n)
        step = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(n) else unit
        b_lo = (lo[unit] // block + step) * block
        b_hi = b_lo + block - 1
        anchor = pos[unit] + part.bounds[row[unit]]
        top, low = part.bounds[row[unit]], part.bounds[row[unit] + 1]
        core, span = _names(prints, top, low, anchor, b_lo, b_hi, s)
        return [keys.take(pa.array(row[unit])), pa.array(pos[unit].astype(np.int32)),
                pa.array(np.maximum(b_lo, lo[unit]).astype(np.int32)), pa.array(np.minimum(b_hi, hi[unit]).astype(np.int32)),
                pa.array(sure[unit]), _i64(core), _i64(span)]

    return make


def _settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ranges that repeat, ranges to cut finer) of rows (k, pos, lo, hi, sure, core, span). A sure range is
    known to repeat already and only there for others to match."""
    spans = rows.groupBy("core", "span").agg(
        F.count(F.lit(1)).alias("n"), F.max("sure").alias("any_sure"),
        F.min(F.struct("k", "pos", "lo", "hi")).alias("one"))
    cores = spans.groupBy("core").agg(
        F.count(F.lit(1)).alias("n_spans"),
        F.sum(F.when((F.col("n") == 1) & ~F.col("any_sure"), 1).otherwise(0)).alias("n_open"))
    repeats = rows.join(spans.filter("n > 1").select("core", "span"), ["core", "span"]).select("k", "pos", "lo", "hi")
    finer = (spans.join(cores.filter("n_spans > 1 and n_open > 0").select("core"), "core")
             .select("one.*", ((F.col("n") > 1) | F.col("any_sure")).alias("sure")))
    return repeats, finer


def repeated_ranges(texts: DataFrame, s: Shape) -> DataFrame:
    """(k, start, stop, in_words): bytes or words of the texts that repeated strings cover; may overlap."""
    first = _scan(texts, _first_ranks(s), s, None, "k long, pos int, rank long")
    lists = (_repeated(first).groupBy("k").agg(F.collect_list("pos").alias("found")))
    rows = written(_scan(texts.join(lists, "k"), _anchor_rows(s), s, "found",
                         "k long, pos int, lo int, hi int, follow array<long>, span long"), "anchors")
    ranked = rows.withColumn("rank", F.col("follow")[0])
    for k in range(1, len(s.steps)):
        ranked = _reranked(ranked, F.col("follow")[k])
    level = ranked.select("k", "pos", "lo", "hi", F.lit(False).alias("sure"), F.col("rank").alias("core"), "span")
    level = written(level, "repeated-cores")
    repeats, finer = _settle(level)
    for block in dict.fromkeys([min(BLOCK, s.window), 1]):
        if block == 1 and s.window == 1:
            break  # cores are whole strings already
        finer = finer.groupBy("k").agg(F.collect_list(F.struct("pos", "lo", "hi", "sure")).alias("ranges"))
        level = written(_scan(texts.join(finer, "k"), _block_rows(s, block), s, "ranges",
                              "k long, pos int, lo int, hi int, sure boolean, core long, span long"), "blocks")
        more, finer = _settle(level)
        repeats = repeats.unionByName(more)
    return repeats.select("k", (F.col("pos") - F.col("hi")).alias("start"),
                          (F.col("pos") - F.col("lo") + s.length).alias("stop"), F.lit(s.in_words).alias("in_words"))


def _merge(start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    order = np.argsort(start, kind="stable")
    out: list[list[int]] = []
    for a, b in zip(start[order].tolist(), stop[order].tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _in_bytes(raw: pa.Buffer, start: np.ndarray, stop: np.ndarray, in_words: np.ndarray) -> list[tuple[int, int]]:
    """Merged ranges in bytes of ranges of bytes and of words."""
    if in_words.any():
        begins, ends, _ = T.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        a, b = np.array(_merge(start[in_words], stop[in_words]), np.int64).T
        start, stop = np.append(start[~in_words], begins[a]), np.append(stop[~in_words], ends[b - 1])
    return _merge(start, stop)


def repeats_by_text(docs: DataFrame, text_col: str, length: int, words: int | None = None) -> DataFrame:
    """(digest, cuts, kept_sha256, all_cuts) of the texts with something to remove, without exact copies: cuts are
    start, stop, start, stop, ... of the merged ranges of repeated strings of ``length`` bytes; all_cuts of those and
    the repeated runs of ``words`` words."""
    texts = distinct_texts(docs, text_col, length, words)
    found = repeated_ranges(texts, shape(length))
    if words is not None:
        found = found.unionByName(repeated_ranges(texts, shape(words, True)))
    ranges = found.groupBy("k").agg(F.collect_list(F.struct("start", "stop", "in_words")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts, kept, every = [], [], []
            offsets, values = batch.column(2).offsets.to_numpy(), batch.column(2).values
            start, stop, in_words = (values.field(n).to_numpy(zero_copy_only=False) for n in ("start", "stop", "in_words"))
            for r, text in enumerate(batch.column(1)):
                raw = text.as_buffer()
                own = slice(offsets[r], offsets[r + 1])
                in_bytes = ~in_words[own]
                merged = _merge(start[own][in_bytes], stop[own][in_bytes])
                cuts.append([x for span in merged for x in span])
                if not in_bytes.all():
                    merged = _in_bytes(raw, start[own], stop[own], in_words[own])
                every.append([x for span in merged for x in span])
                kept.append(hashlib.sha256(_without(memoryview(raw), cuts[-1])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cuts, pa.list_(pa.int64())), pa.array(kept, pa.string()),
                 pa.array(every, pa.list_(pa.int64()))], ["digest", "cuts", "kept_sha256", "all_cuts"])

    return texts.join(ranges, "k").select("digest", "text", "ranges").mapInArrow(
        run, "digest string, cuts array<long>, kept_sha256 string, all_cuts array<long>")


def _without(raw: memoryview | bytes, cuts: list[int]) -> bytes:
    at, out = 0, []
    for a, b in zip(cuts[::2], cuts[1::2]):
        out.append(bytes(raw[at:a]))
        at = b
    return b"".join([*out, bytes(raw[at:])])


def _copies(docs: DataFrame, text_col: str, length: int, words: int | None = None) -> DataFrame:
    """Digests of texts of at least ``length`` bytes or ``words`` words that several rows have."""
    return (docs.filter(_long(text_col, length, words)).groupBy(_key(text_col)[0].alias("digest"))
            .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", F.lit(True).alias("copied")))


def _spans(copied: Column, cuts: Column, size: Column) -> tuple[Column, Column]:
    """Bytes and number of the spans ``cuts``, a copied text being one whole span."""
    removed = F.aggregate(cuts, F.lit(0).cast("long"), lambda t, x: x - t)  # -start + stop - start + ...
    return (F.when(copied, size).otherwise(removed),
            F.when(copied, F.lit(1).cast("long")).otherwise((F.size(cuts) / 2).cast("long")))


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                  words: int | None = None) -> DataFrame:
    """One row per document row: n_bytes, n_removed, n_spans and the digest of the bytes that stay, by repeated
    strings of ``length`` bytes. With ``words`` also passage_bytes and n_passages: bytes and spans covered when
    runs of as many words that occur again count too."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), _size(text_col).alias("n_bytes"), _key(text_col)[0].alias("digest"),
                       F.sha2(text.cast("binary"), 256).alias("whole"))
    copies = _copies(docs, text_col, length, words)
    found = copies.join(repeats_by_text(docs, text_col, length, words), "digest", "full")
    joined = rows.join(found, "digest", "left")
    many = F.coalesce(F.col("copied"), F.lit(False))
    copied = many & (F.col("n_bytes") >= length)
    none = F.array().cast("array<long>")
    removed, spans = _spans(copied, F.coalesce("cuts", none), F.col("n_bytes"))
    out = [F.col(id_col), "n_bytes", removed.alias("n_removed"), spans.alias("n_spans"),
           F.when(copied, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256")]
    if words is not None:
        passage, number = _spans(many, F.coalesce("all_cuts", none), F.col("n_bytes"))
        out += [passage.alias("passage_bytes"), number.alias("n_passages")]
    return joined.select(*out)


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = 400, words: int | None = None) -> DataFrame:
    """``docs`` with all rows and columns, repeated bytes (and runs of ``words`` words) cut out of the text (bytes that are no longer
    whole characters at a cut become U+FFFD). Texts without repeats are returned unchanged."""
    names = docs.columns
    key, cut_col, copy_col = ("_digest", "_cuts", "_copied")
    while {key, cut_col, copy_col} & set(names):
        key, cut_col, copy_col = "_" + key, "_" + cut_col, "_" + copy_col
    found = (_copies(docs, text_col, length, words).join(repeats_by_text(docs, text_col, length, words), "digest", "full")
             .select(F.col("digest").alias(key), F.col("all_cuts").alias(cut_col), F.col("copied").alias(copy_col)))
    joined = docs.withColumn(key, _key(text_col)[0]).join(found, key, "left").select(*names, cut_col, copy_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for batch in batches:
            cuts, copied = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            cols = list(batch.columns[: len(names)])
            if any(copied) or any(cuts):
                cols[at] = pa.array(["" if c else _without(t.encode(), x).decode("utf-8", "replace") if x else t
                                     for t, x, c in zip(cols[at].to_pylist(), cuts, copied)], pa.string())
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(run, docs.schema)
