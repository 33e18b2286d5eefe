"""Exact n-gram Jaccard self-join with a token-group matrix, and the components of its links.

A document's set are its distinct shingles (64-bit names). Two sets x, y link when their Jaccard
similarity reaches ``percent``. If they do, the first |x| - ceil(t |x|) + 1 tokens of x and the like of y
share one, in any common order of all tokens. The order here is: rare tokens by name, then frequent
ones by name (tokens in more than ``HOT`` classes, marked in a bitmap of fixed size), so a passage that many
documents share is asked for last and a set seldom meets others through it.

1. Equal sets are one class, found by a fingerprint of the set; classes without a shared prefix token
   have no links and are done.
2. Each class is compared with one hub: of the smallest classes of its shared tokens the one that most of them
   have. Links make components, so large families are joined in a number of pairs that grows with their size.
3. Token-group matrix: similar classes (of one component or with the same most frequent token, and of like
   size) form groups of about ``GROUP`` members; the matrix holds which token occurs in which group's
   prefixes. A class counts its prefix tokens in each group and asks only the groups where a member could
   still reach t with that many; groups of its own component are not asked. A group that is asked opens for
   the classes whose overlap with the union of all its tokens reaches t |x|, and all its members are
   counted at once; of the links in a task those are kept that join components.
4. Components again, over all links.

Every pair of linked classes is in one component: it is compared in step 2 or 3 unless it is joined already.
Nothing is capped. Skew: copies collapse in their task before any shuffle; token counts are aggregated
before the shuffle; the classes that ask one group are dealt over tasks of about ``ASKERS``.

Defined results: a text without words (NULL, empty) has no shingles and links with nothing; fewer words than
the width make one shingle of the whole sequence; the component is named by its smallest id (NULL ids
count as largest; a component of NULL ids only is NULL); repeated rows are copies; an empty table gives no
rows; extra columns are ignored by ``near_duplicates``, kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispersa.llm import text as T
from dispersa.llm.components import connected
from dispersa.llm.shared import release_worker, written

HOT = 32
HOT_BITS = 24  # log2 of the bitmap's bits: 2 MB
WINDOW_PERCENT = 20  # share of a set's tokens whose frequency is counted
GROUP = 256
ASKERS = 512


class Join(NamedTuple):
    width: int = 4  # words of a shingle
    percent: int = 85  # similarity from which two sets link

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """Tokens of a set of n of which one must be shared."""
        return n - (self.percent * n + 99) // 100 + (n > 0)

    def links(self, common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * common >= self.percent * (a + b - common)


class Sets(NamedTuple):
    """Sets of a slice: distinct tokens sorted within each row, tokens before each row, class of each row."""

    tokens: np.ndarray
    before: np.ndarray
    classes: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.before)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.classes)), self.sizes)


def _sort_rows(values: np.ndarray, before: np.ndarray) -> None:
    """Sorts the values of each row in place: a sort of plain numbers takes a tenth of one by rows and values."""
    bounds = before.tolist()
    for a, b in zip(bounds[:-1], bounds[1:]):
        values[a:b].sort()


def sets_of(part: T.Slice, join: Join) -> Sets:
    data = T.LOWER[part.data]
    starts, ends, before = T.words(data, part.bounds)
    names = T.Fingerprints(data).of(starts, ends)
    tokens, rows = T.shingles(names, before, join.width)
    _sort_rows(tokens, np.searchsorted(rows, np.arange(part.rows + 1)))
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (rows[1:] != rows[:-1])
    tokens, rows = tokens[new], rows[new]
    bounds = np.searchsorted(rows, np.arange(part.rows + 1))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(T.mix(tokens ^ T.U64(0xA0761D6478BD642F)))])
    classes = T.mix((total[bounds[1:]] - total[bounds[:-1]]) + T.mix(np.diff(bounds).astype(np.uint64)))
    return Sets(tokens, bounds, classes)


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def classes(docs: DataFrame, id_col: str, text_col: str, join: Join) -> DataFrame:
    """(id, n_shingles, c, h): the class, NULL for empty sets, and a hash of the text."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            for part in T.slices(batch.column(1)):
                s = sets_of(part, join)
                here = batch.slice(part.first, part.rows)
                c = pa.array(s.classes.view(np.int64), mask=s.sizes == 0)
                yield pa.RecordBatch.from_arrays([here.column(0), pa.array(s.sizes, pa.int64()), c, here.column(2)],
                                                 ["id", "n_shingles", "c", "h"])

    return docs.select(F.col(id_col), F.col(text_col), F.xxhash64(text_col)).mapInArrow(
        run, f"id {kind}, n_shingles long, c long, h long")


def _first_rows(s: Sets, seen: set, hashes: np.ndarray | None = None) -> np.ndarray:
    """Rows with a non-empty set whose class this task has not had yet (with ``hashes``: whose class and hash)."""
    out = np.zeros(len(s.classes), bool)
    keys = s.classes.tolist() if hashes is None else list(zip(s.classes.tolist(), hashes.tolist()))
    for r, (key, n) in enumerate(zip(keys, s.sizes.tolist())):
        if n and key not in seen:
            seen.add(key)
            out[r] = True
    return out


def _bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """Bits of the first ``HOT_BITS`` bits of a column's values. Collected as at most 2**HOT_BITS / 32 words."""
    slot = F.shiftrightunsigned(column, 64 - HOT_BITS)
    bits = rows.select(F.shiftright(slot, 5).alias("word"), slot.bitwiseAND(F.lit(31)).alias("bit"))
    bits = bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits")).toPandas()
    out = np.zeros(1 << (HOT_BITS - 5), np.uint32)
    out[bits["word"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def _marked(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = (values >> T.U64(64 - HOT_BITS)).astype(np.int64)
    return (bitmap[slot >> 5] >> (slot & 31).astype(np.uint32)) & np.uint32(1)


def class_texts(docs: DataFrame, text_col: str, join: Join, placed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, text): one row for each class of ``wanted``. ``placed``: the classes of all documents. One text of
    each class is picked by its hash; a bitmap of these keeps most other texts out of the shuffle, the join
    the rest. A task may meet texts of a class that pass by a shared bit before the picked one, so it keeps one
    row of each class and hash."""
    picks = written(placed.join(wanted, "c", "left_semi").groupBy("c").agg(F.min("h").alias("h")), "class-picks")
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(picks, "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            hashes = batch.column(1).to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(_marked(shared.value, hashes) > 0))
            for part in T.slices(batch.column(0)):
                s = sets_of(part, join)
                here = batch.slice(part.first, part.rows)
                first = _first_rows(s, seen, here.column(1).to_numpy())
                yield pa.RecordBatch.from_arrays([_i64(s.classes), here.column(1), here.column(0)],
                                                 ["c", "h", "text"]).filter(pa.array(first))

    texts = docs.select(F.col(text_col), F.xxhash64(text_col)).mapInArrow(run, "c long, h long, text string")
    return written(texts.join(picks, ["c", "h"], "left_semi").dropDuplicates(["c"]).select("c", "text"), "class-texts")


def frequent_tokens(docs: DataFrame, text_col: str, join: Join) -> np.ndarray:
    """Bitmap of the tokens that more than ``HOT`` classes have among the first fifth of their names. A token
    that shares a bit with a frequent one only moves in the order, which every set follows alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        seen: set[int] = set()
        for batch in batches:
            for part in T.slices(batch.column(0)):
                s = sets_of(part, join)
                rows = s.rows
                rank = np.arange(len(s.tokens)) - s.before[rows]
                keep = (rank * 100 <= WINDOW_PERCENT * s.sizes[rows]) & _first_rows(s, seen)[rows]
                yield pa.RecordBatch.from_arrays([_i64(s.tokens[keep])], ["tok"])

    counts = docs.select(F.col(text_col)).mapInArrow(run, "tok long").groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    return _bitmap(counts.filter(F.col("n") > HOT), "tok")


def _ordered(s: Sets, hot: np.ndarray) -> np.ndarray:
    """Token ids whose unsigned order within each row is the join's order: rare ones first."""
    ids = (s.tokens >> T.U64(1)) | (_marked(hot, s.tokens).astype(np.uint64) << T.U64(63))
    _sort_rows(ids, s.before)
    return ids


def prefixes(docs: DataFrame, text_col: str, join: Join, hot: np.ndarray) -> DataFrame:
    """(tok, c, n, i): the prefix tokens of every class with the token's place. A class may come from
    several tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        seen: set[int] = set()
        for batch in batches:
            for part in T.slices(batch.column(0)):
                s = sets_of(part, join)
                ids, rows = _ordered(s, shared.value), s.rows
                rank = np.arange(len(ids)) - s.before[rows]
                keep = (rank < join.prefix(s.sizes)[rows]) & _first_rows(s, seen)[rows]
                rows = rows[keep]
                yield pa.RecordBatch.from_arrays(
                    [_i64(ids[keep]), _i64(s.classes[rows]), pa.array(s.sizes[rows].astype(np.int32)),
                     pa.array(rank[keep].astype(np.int32))], ["tok", "c", "n", "i"])

    return docs.select(F.col(text_col)).mapInArrow(run, "tok long, c long, n int, i int")


def _may_link(join: Join, n1: str, i1: str, n2: str, i2: str):
    """Length and place bound of two sets that share the tokens at places i1 and i2."""
    most = F.least(F.col(i1), F.col(i2)) + 1 + F.least(F.col(n1) - F.col(i1), F.col(n2) - F.col(i2)) - 1
    return (most * (100 + join.percent) >= (F.col(n1) + F.col(n2)) * join.percent) & (
        F.least(n1, n2) * 100 >= F.greatest(n1, n2) * join.percent)


def _least_common(join: Join, n1, n2):
    """Prefix tokens that two linked sets of these sizes share at least. All tokens up to the place where
    the first of the two prefixes ends are known; beyond it one set has only n - prefix tokens left."""
    t = join.percent
    overlap = F.ceil((n1 + n2) * t / (100 + t))
    return F.least(overlap - F.ceil(n1 * t / 100), overlap - F.ceil(n2 * t / 100)) + 1


def _hub_pairs(shared: DataFrame, join: Join) -> DataFrame:
    """(c, h): each class with the hub that most of its shared tokens have, if they are not too few for a
    link (a class without one is left to the groups)."""
    hubs = shared.groupBy("tok").agg(F.min(F.struct("c", "n", "i")).alias("hub")).select(
        "tok", F.col("hub.c").alias("h"), F.col("hub.n").alias("hn"), F.col("hub.i").alias("hi"))
    asked = shared.join(hubs, "tok").filter((F.col("c") != F.col("h")) & _may_link(join, "n", "i", "hn", "hi"))
    pairs = asked.groupBy("c", "h", "n", "hn").agg(F.count(F.lit(1)).alias("common"))
    pairs = pairs.filter(F.col("common") * 2 >= _least_common(join, F.col("n"), F.col("hn")))
    return pairs.groupBy("c").agg(F.max(F.struct("common", "h")).getField("h").alias("h"))


def _hub_links(pairs: DataFrame, texts: DataFrame, join: Join) -> DataFrame:
    """Links (a, b) among the pairs."""
    both = (pairs.join(texts, "c").select("c", "h", F.col("text").alias("t"))
            .join(texts.select(F.col("c").alias("h"), F.col("text").alias("u")), "h").select("c", "h", "t", "u"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                left, right = _token_lists(part.column(2), join), _token_lists(part.column(3), join)
                common = np.array([len(np.intersect1d(x, y, True)) for x, y in zip(left, right)], np.int64)
                a, b = np.array([len(x) for x in left], np.int64), np.array([len(y) for y in right], np.int64)
                yield part.select(["c", "h"]).rename_columns(["a", "b"]).filter(pa.array(join.links(common, a, b)))

    return both.mapInArrow(run, "a long, b long")


def _token_lists(column: pa.Array, join: Join) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for part in T.slices(column):
        s = sets_of(part, join)
        out += [s.tokens[a:b] for a, b in zip(s.before[:-1], s.before[1:])]
    return out


def _group_links(docs: DataFrame, text_col: str, placed_docs: DataFrame, shared: DataFrame, labels: DataFrame,
                 join: Join) -> DataFrame:
    """Links (a, b) between components, by the token-group matrix."""
    rows = shared.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    # A token whose classes are all of one component leads to no new link.
    mixed = (rows.groupBy("tok").agg(F.min("label").alias("l"), F.max("label").alias("m"), F.count(F.lit(1)).alias("df"))
             .filter("l != m").select("tok", "df"))
    rows = written(rows.join(mixed, "tok"), "matrix-rows")
    # Groups: classes of one component, or single ones whose most frequent token is the same (so that a large
    # family falls into few groups); sizes within a tenth.
    kin = rows.groupBy("c", "n", "label").agg(F.max(F.struct("df", "tok")).getField("tok").alias("common"))
    kind = F.when(F.col("label") != F.col("c"), F.col("label")).otherwise(F.col("common"))
    seeds = kin.withColumn("seed", F.xxhash64(kind, F.floor(F.log(F.col("n")) / float(np.log(1.1)))))
    sizes = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("members"))
    groups = written(seeds.join(sizes, "seed").select(
        "c", "n", "label", F.xxhash64("seed", F.pmod(F.xxhash64("c"), F.ceil(F.col("members") / GROUP))).alias("g")), "groups")
    placed = rows.join(groups.select("c", "g"), "c")
    # The matrix: token and group, with the span of the labels of the members that have the token.
    matrix = placed.groupBy("tok", "g").agg(F.min("label").alias("l"), F.max("label").alias("m"))
    extent = groups.groupBy("g").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    # A pair of groups is asked from one side only.
    counted = (placed.withColumnRenamed("g", "own").join(matrix, "tok")
               .filter((F.col("own") >= F.col("g")) & ((F.col("l") != F.col("label")) | (F.col("m") != F.col("label"))))
               .groupBy("c", "g", "label", "n").agg(F.count(F.lit(1)).alias("common")))
    t, n = join.percent, F.col("n")
    # The bound falls with the size of the larger set and grows with the smaller one's.
    low = F.ceil((n + F.col("least")) * t / (100 + t)) - F.ceil(n * t / 100)
    high = F.ceil((n + F.col("most")) * t / (100 + t)) - F.ceil(F.col("most") * t / 100) - 1
    asks = (counted.join(extent, "g")
            .filter((F.col("most") * 100 >= n * t) & (n * 100 >= F.col("least") * t))
            .filter(F.col("common") >= F.least(low, high) + 1)
            .select("c", "g", "label"))
    asks = written(asks, "group-asks")
    open_groups = asks.select("g").distinct()
    texts = class_texts(docs, text_col, join, placed_docs, asks.select("c").unionByName(
        groups.join(open_groups, "g", "left_semi").select("c")).distinct())
    dealt = asks.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / ASKERS).alias("deals"))
    queries = (asks.join(dealt, "g").withColumn("deal", F.pmod(F.xxhash64("c"), F.col("deals")))
               .join(texts, "c").select("g", "deal", "c", "label", "text"))
    members = (groups.join(dealt, "g").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)))
               .join(texts, "c").select("g", "deal", "c", "label", "text")
               .toDF("g", "deal", "c", "label", "text"))  # columns of their own, apart from the queries'

    def opened(_key, asking: pa.Table, group: pa.Table) -> pa.Table:
        members = _token_lists(group.column("text").combine_chunks(), join)
        owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
        tokens = np.concatenate(members) if members else np.zeros(0, np.uint64)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        size = np.array([len(m) for m in members], np.int64)
        c, label = (group.column(n).to_numpy() for n in ("c", "label"))
        a, b = [], []
        joined: dict[int, int] = {}  # components that links of this task have joined

        def root(x: int) -> int:
            while (up := joined.get(x, x)) != x:
                joined[x] = joined.get(up, up)
                x = up
            return x

        for lo in range(0, asking.num_rows, 256):
            part = asking.slice(lo, 256)
            lists = _token_lists(part.column("text").combine_chunks(), join)
            for q, ql, x in zip(part.column("c").to_pylist(), part.column("label").to_pylist(), lists):
                first, last = np.searchsorted(tokens, x, "left"), np.searchsorted(tokens, x, "right")
                have = last > first
                if 100 * have.sum() < join.percent * len(x):
                    continue  # the bound by the union of the group's tokens
                n = (last - first)[have]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[have], n)
                common = np.bincount(owner[at], minlength=len(members))
                hit = np.flatnonzero(join.links(common, len(x), size) & (label != ql))
                for m, other in zip(c[hit].tolist(), label[hit].tolist()):
                    if (x1 := root(ql)) != (x2 := root(other)):  # else a path joins them already
                        joined[x1] = x2
                        a.append(q)
                        b.append(m)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return queries.groupBy("g", "deal").cogroup(members.groupBy("g", "deal")).applyInArrow(opened, "a long, b long")


def _components(docs: DataFrame, id_col: str, text_col: str, join: Join) -> DataFrame:
    """One row per document row: id, n_shingles, h (the hash of its text), component_id."""
    placed = written(classes(docs, id_col, text_col, join), "classes")
    hot = frequent_tokens(docs, text_col, join)
    rows = prefixes(docs, text_col, join, hot)
    again = rows.groupBy("tok").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1").select("tok")
    # Copies of a class from several tasks meet here.
    shared = written(rows.join(again, "tok").distinct(), "shared-prefixes")
    pairs = written(_hub_pairs(shared, join), "hub-pairs")
    wanted = pairs.select("c").unionByName(pairs.select(F.col("h").alias("c"))).distinct()
    texts = class_texts(docs, text_col, join, placed, wanted)
    links = written(_hub_links(pairs, texts, join), "hub-links")
    labels = connected(links)
    links = links.unionByName(_group_links(docs, text_col, placed, shared, labels, join))
    labels = connected(written(links, "links"))
    placed = placed.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    least = placed.filter("label is not null").groupBy("label").agg(F.min("id").alias("component_id"))
    return placed.join(least, "label", "left").select(
        F.col("id").alias(id_col), "n_shingles", "h",
        F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:
    """One row per document row: id, n_shingles, component_id."""
    return _components(docs, id_col, text_col, join).select(id_col, "n_shingles", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:
    """``docs`` with all columns, without the documents that are not the smallest id of their component.
    Rows that repeat the smallest id stay together; rows with a NULL id stay; of an id with several texts only
    the rows go whose text is a near copy."""
    found = _components(docs.select(id_col, text_col), id_col, text_col, join)
    gone = found.filter(F.col(id_col) != F.col("component_id")).select(
        F.col(id_col).alias("_gone"), F.col("h").alias("_gone_h")).distinct()
    gone = written(gone, "near-copies")
    return docs.join(gone, (docs[id_col] == gone["_gone"]) & (F.xxhash64(docs[text_col]) == gone["_gone_h"]), "left_anti")
