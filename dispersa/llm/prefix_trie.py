"""Prefix trie of conversations by a splitter skeleton.

A conversation is the sequence of its turns; two share a trie node as deep as their first turns are equal. A
path is written as one binary value, 16 bytes of SHA-256 a turn, so that paths sort like the sequences.

1. ``classes``: conversations of one path become one row with their number, smallest id and the digest of their
   ids. Ids are combined in blocks (``ID_BLOCK`` id values) first, so a path that a third of all conversations
   share is spread over tasks; only the SHA-256 chain over its finished blocks runs in one.
2. Splitters: a hash sample of the paths (about ``SAMPLES`` a shard, cut to ``SPLITTER_TURNS`` turns) gives
   range borders. All prefixes of the splitters form the skeleton, which every task gets: at most
   ``MAX_SHARDS * SPLITTER_TURNS + 1`` nodes. Only skeleton nodes can reach over shards.
3. Each shard is sorted and read once with a stack: nodes outside the skeleton lie whole in the shard and are
   finished there; of skeleton nodes the task returns what its shard adds. A node waits for its parent's
   smallest id; what waits is bounded by a shard, as a node of more shards is in the skeleton.
4. The skeleton's partial aggregates are summed by Spark; the driver rolls up that small tree, and the nodes
   whose parent is in it get the parent's id by a broadcast join.

A path is one value of 16 bytes a turn (and 4 for its words), which bounds a single conversation to some 10^8
turns; nothing else depends on its length.

Defined results: rows with a NULL conversation id are left out (no id, no member); NULL role or text is empty;
turns go by number, NULL first, then by fingerprint; repeated rows are turns of their own; repeated
conversation ids in ``prefix_trie`` are members each. An empty table has no nodes, not even a root. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispersa.llm.shared import written

TURN = 16                 # bytes of a turn in a path
ID_BLOCK = 1 << 16        # id values whose ids are joined in one task
SHARD_TURNS = 1 << 17     # turns of distinct paths in a shard
SAMPLES = 16              # sampled paths a shard
SPLITTER_TURNS = 64       # a splitter has at most so many turns
MAX_SHARDS = 1 << 14
OUT_ROWS = 4096


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, mark, words)``: each turn's fingerprint and number of words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * TURN)).alias("mark"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))


def _paths(batch_rows: Iterator[tuple], borrowed: int) -> Iterator[tuple]:
    """``(conv_id, path, words)`` from rows sorted by base, base's own first, conversation and place."""
    base, heads = None, []
    conv, own = None, []

    def rebuilt():
        h = zlib.crc32(str(conv).encode()) % borrowed
        turns = heads[:h] + own[h:]
        return conv, b"".join(m for m, _ in turns), np.array([w for _, w in turns], np.int32).tobytes()

    for b, c, mark, words in batch_rows:
        if c != conv:
            if conv is not None:
                yield rebuilt()
            if b != base:
                base, heads = b, []
            conv, own = c, []
        if c == b and len(heads) < borrowed - 1:
            heads.append((mark, words))
        own.append((mark, words))
    if conv is not None:
        yield rebuilt()


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], limit: int = OUT_ROWS,
             size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if len(held) >= limit or held_bytes >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, held_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def rebuild(conversations: DataFrame, every: int = 20, borrowed: int = 4) -> DataFrame:
    """``(conv_id, path, words)``: conversation ``c`` starts with the first ``h`` turns of conversation
    ``c - c % every`` (remainder with the sign of ``c``), ``h = crc32(c) % borrowed``, then has its own turns
    after its first ``h``. Turnless results are kept (an empty path)."""
    turns = turns_of(conversations).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    sorted_turns = turns.repartition("base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.asc_nulls_first("turn"), "mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_paths(_rows(batches), borrowed), ["conv_id", "path", "words"],
                            [pa.int64(), pa.binary(), pa.binary()])

    return sorted_turns.select("base", "conv_id", "mark", "words").mapInArrow(run, "conv_id bigint, path binary, words binary")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by path and block -> one row a path, with the digest over all ids in order."""

    def classes() -> Iterator[tuple]:
        here = None
        for path, words, n, least, ids in _rows(batches):
            if here is None or here[0] != path:
                if here is not None:
                    yield (*here[:4], here[4].hexdigest())
                here = [path, words, 0, least, hashlib.sha256()]
            else:
                here[4].update(b",")
            here[2] += n
            here[3] = min(here[3], least)
            here[4].update(ids.encode())
        if here is not None:
            yield (*here[:4], here[4].hexdigest())

    yield from _batches(classes(), ["path", "words", "n", "least", "ends"],
                        [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.string()])


def path_classes(paths: DataFrame) -> DataFrame:
    """``(path, words, n, least, ends)``: each distinct path once."""
    block = F.floor(F.col("conv_id") / F.lit(ID_BLOCK)).alias("block")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = paths.groupBy("path", "words", block).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), ids.alias("ids"))
    dealt = blocks.repartition("path").sortWithinPartitions("path", "block")
    return dealt.select("path", "words", "n", "least", "ids").mapInArrow(
        _chain, "path binary, words binary, n bigint, least bigint, ends string")


def splitters(classes: DataFrame, shard_turns: int) -> list[bytes]:
    """Range borders of about equal shards: prefixes of sampled paths, in order."""
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("path")).alias("bytes")).first()
    n, turns = int(size["n"]), int(size["bytes"] or 0) // TURN
    cores = classes.sparkSession.sparkContext.defaultParallelism
    shards = min(MAX_SHARDS, max(-(-turns // shard_turns), min(cores, -(-turns // 4096))))
    if shards < 2:
        return []
    share = max(1, n // (SAMPLES * shards))
    sample = classes.where(F.pmod(F.xxhash64("path"), F.lit(share)) == 0).select(
        F.substring("path", 1, SPLITTER_TURNS * TURN).alias("s")).collect()
    found = sorted(bytes(r["s"]) for r in sample)
    return sorted({found[i * len(found) // shards] for i in range(1, shards)}) if found else []


def skeleton(borders: list[bytes]) -> list[bytes]:
    """All prefixes of the splitters, the root first, in order."""
    return sorted({s[: d] for s in borders for d in range(0, len(s) + 1, TURN)} | {b""})


class _Node:
    __slots__ = ("depth", "skeleton", "words", "n", "least", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, depth: int, skeleton: int | None, words: int):
        self.depth, self.skeleton, self.words = depth, skeleton, words
        self.n, self.least, self.children, self.leaves, self.saved = 0, None, 0, 0, 0
        self.ends, self.waiting = None, []

    def add(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


NO_ENDS = hashlib.sha256(b"").hexdigest()


def _close(node: _Node, parent: _Node | None) -> Iterator[tuple]:
    """Rows that the end of a node's subtree makes final."""
    if node.skeleton is not None:
        yield (node.skeleton, None, node.least, node.depth, None, node.n, node.children, node.leaves, node.saved,
               node.ends, node.words)
        for row in node.waiting:
            yield (None, node.skeleton, *row)
        return
    for conv, depth, _, *rest in node.waiting:
        yield (None, None, conv, depth, node.least, *rest)
    leaves = node.leaves if node.children else 1
    saved = node.saved + (node.n - 1) * node.words
    parent.waiting.append((node.least, node.depth, None, node.n, node.children, leaves, saved,
                           node.ends or NO_ENDS, node.words))
    parent.add(node.n, node.least)
    parent.children += 1
    parent.leaves += leaves
    parent.saved += saved


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common."""
    top = min(len(a), len(b))
    if a[:top] == b[:top]:
        return top // TURN
    lo, hi = 0, top // TURN
    while lo < hi:  # the first turns of one path are equal up to a point
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[: mid * TURN] == b[: mid * TURN] else (lo, mid - 1)
    return lo


def shard_nodes(classes: Iterator[tuple], places: dict[bytes, int]) -> Iterator[tuple]:
    """Nodes of sorted ``(path, words, n, least, ends)``; ``places`` numbers the skeleton's paths."""
    stack: list[_Node] = []
    before = b""
    for path, words, n, least, ends in classes:
        if not stack:
            stack.append(_Node(0, places[b""], 0))
        keep = _common(before, path)
        while len(stack) - 1 > keep:
            node = stack.pop()
            yield from _close(node, stack[-1])
        sizes = np.frombuffer(words, np.int32)
        for depth in range(len(stack), len(path) // TURN + 1):
            place = places.get(path[: depth * TURN]) if stack[-1].skeleton is not None else None
            stack.append(_Node(depth, place, int(sizes[depth - 1])))
        stack[-1].add(n, least)
        stack[-1].ends = ends
        before = path
    while stack:
        node = stack.pop()
        yield from _close(node, stack[-1] if stack else None)


_NODE = ["place", "parent_place", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
         "saved_tokens", "ends_sha256", "words"]
_KINDS = [pa.int64()] * 9 + [pa.string(), pa.int64()]
_RESULT = [c for c in _NODE if c not in ("place", "parent_place", "words")]


def _roll_up(paths: list[bytes], partial: dict[int, dict]) -> list[tuple]:
    """Finished rows of the skeleton's nodes from their summed partial aggregates, children before parents."""
    at = {p: i for i, p in enumerate(paths)}
    nodes = []
    for i in range(len(paths)):
        p = partial[i]
        nodes.append({**p, "kids": p["n_children"]})
    rows = [None] * len(paths)
    for i in sorted(range(len(paths)), key=lambda i: -len(paths[i])):
        x = nodes[i]
        x["leaves"] = x["n_leaves"] if x["kids"] else 1
        x["saved"] = x["saved_tokens"] + (x["n_convs"] - 1) * x["words"]
        if paths[i]:
            up = nodes[at[paths[i][:-TURN]]]
            up["n_convs"] += x["n_convs"]
            up["conv_id"] = x["conv_id"] if up["conv_id"] is None else min(up["conv_id"], x["conv_id"])
            up["kids"] += 1
            up["n_leaves"] += x["leaves"]
            up["saved_tokens"] += x["saved"]
    for i, path in enumerate(paths):
        x = nodes[i]
        parent = nodes[at[path[:-TURN]]]["conv_id"] if path else None
        rows[i] = (i, x["conv_id"], len(path) // TURN, parent, x["n_convs"], x["kids"], x["leaves"], x["saved"],
                   x["ends_sha256"] or NO_ENDS)
    return rows


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``: one row a
    node of the trie of ``(conv_id, path, words)`` (see ``rebuild``)."""
    spark = paths.sparkSession
    classes = written(path_classes(paths), "paths")
    borders = splitters(classes, shard_turns)
    nodes = skeleton(borders)
    shared = spark.sparkContext.broadcast((borders, nodes))

    def shard_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = shared.value[0]
        for b in batches:
            found = [bisect_right(edges, p) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.int32())], names=[*b.schema.names, "shard"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {p: i for i, p in enumerate(shared.value[1])}
        yield from _batches(shard_nodes(_rows(batches), places), _NODE, _KINDS)

    fields = "path binary, words binary, n bigint, least bigint, ends string"
    dealt = classes.mapInArrow(shard_of, f"{fields}, shard int").repartitionById(len(borders) + 1, "shard").sortWithinPartitions("path")
    schema = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'bigint'}" for c in _NODE)
    found = written(dealt.drop("shard").mapInArrow(local, schema), "nodes")
    partial = found.where("place IS NOT NULL").groupBy("place").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("ends_sha256").alias("ends_sha256"), F.max("words").alias("words")).collect()
    rows = _roll_up(nodes, {r["place"]: r.asDict() for r in partial}) if partial else []
    kinds = "place bigint, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
    top = spark.createDataFrame(rows, kinds)
    parents = F.broadcast(top.select(F.col("place").alias("parent_place"), F.col("conv_id").alias("_parent")))
    inner = found.where("place IS NULL").join(parents, "parent_place", "left")
    inner = inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent"))
    return inner.select(*_RESULT).unionByName(top.select(*_RESULT))
