"""Farthest pair of many wide points: a ball tree over the points and dual-tree branch and bound.

1. A bounded sample (``SAMPLE_CELLS`` coordinates, on the driver) is halved along its long axis until a leaf
   stands for about half a block of points: a complete binary tree of split planes, which every task gets.
2. One pass deals the points to the leaves and measures each leaf's ball (centre: the sample's mean; radius: the
   farthest of all its points) and each pivot's farthest point; a second pass measures the farthest distance
   from those points, a lower bound ``LB`` on the answer that is mostly close to it.
3. Branch and bound on pairs of tree nodes (driver, a few numbers a node): a pair is followed only while
   ``|ca - cb| + ra + rb >= LB``. What is left are the opened leaf pairs.
4. A third pass copies a point to the opened pairs of its leaf for which ``|p - c| + r >= LB`` holds for the
   point itself, and the block kernel of ``operators.pairs`` compares the copies exactly. A leaf with more
   points than a block is cut into blocks by a hash of the id, so copies of one point spread.

The answer equals the comparison of all pairs, ties included: bounds have a relative slack far above rounding.
Points that no ball separates (spread evenly in many dimensions) leave most pairs open: from ``OPEN_SHARE`` on
the search says so in ``reason`` and the caller compares hashed blocks instead, without the copies' third pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispersa.operators import pairs
from dispersa.operators.pairs import _matrix, _sqdist

SAMPLE_CELLS = 1 << 20   # coordinates of the sample on the driver
SAMPLE_LEAF = 16         # sampled points a leaf
LEAVES_MAX = 1 << 12
PIVOTS = 16
OPEN_SHARE = 0.5         # share of opened pairs from which hashed blocks are cheaper
SLACK = 1e-9


class Tree(NamedTuple):
    """Split planes of a complete binary tree (root 0, children ``2i+1``, ``2i+2``) and the leaves' centres."""

    depth: int
    planes: np.ndarray    # inner nodes x width
    cuts: np.ndarray
    centres: np.ndarray   # leaves x width


class Search(NamedTuple):
    best: DataFrame | None   # (sqd, i, j) of each opened block pair; None if it was given up
    leaves: int
    pairs: int               # leaf pairs in all
    opened: int
    reason: str | None       # why hashed blocks should be compared instead


def build(sample: np.ndarray, leaves: int) -> Tree:
    """A tree of at most ``leaves`` leaves over the sample (at least one row)."""
    depth = max(0, min(int(math.log2(max(1, leaves))), int(math.log2(max(1, len(sample) // 2)))))
    inner = 2 ** depth - 1
    planes, cuts = np.zeros((inner, sample.shape[1])), np.zeros(inner)
    centres = np.zeros((2 ** depth, sample.shape[1]))
    rows = {0: np.arange(len(sample))}
    for node in range(inner):
        x = sample[rows[node]]
        if len(x):
            a = x[np.argmax(((x - x[0]) ** 2).sum(axis=1))]
            b = x[np.argmax(((x - a) ** 2).sum(axis=1))]
            planes[node] = b - a
            along = x @ planes[node]
            cuts[node] = np.median(along)
            right = along > cuts[node]
        else:
            right = np.zeros(0, bool)
        rows[2 * node + 1], rows[2 * node + 2] = rows[node][~right], rows[node][right]
    for leaf in range(2 ** depth):
        at = node = inner + leaf
        while not len(rows[at]):  # a side without samples: its parent's centre
            at = (at - 1) // 2
        centres[leaf] = sample[rows[at]].mean(axis=0) if len(rows[at]) else 0.0
    return Tree(depth, planes, cuts, centres)


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    node = np.zeros(len(x), np.int64)
    for _ in range(tree.depth):
        right = np.einsum("ij,ij->i", x, tree.planes[node]) > tree.cuts[node]
        node = 2 * node + 1 + right
    return node - (2 ** tree.depth - 1)


def _measure(tree: tuple, pivots: np.ndarray):
    """Rows ``(leaf, n, radius)`` and, with ``leaf`` NULL, ``(pivot, sqd, id, p)`` of a task's points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tree(*tree)
        leaves = len(t.centres)
        n, radius = np.zeros(leaves, np.int64), np.zeros(leaves)
        far: list = [None] * len(pivots)
        for b in batches:
            if not b.num_rows:
                continue
            ids, x = b.column(0).to_numpy(), _matrix(b.column(1), t.centres.shape[1])
            leaf = leaf_of(t, x)
            n += np.bincount(leaf, minlength=leaves)
            np.maximum.at(radius, leaf, np.sqrt(((x - t.centres[leaf]) ** 2).sum(axis=1)))
            d = _sqdist(pivots, x)
            for i in range(len(pivots)):
                k = int(np.argmax(d[i]))
                if far[i] is None or d[i, k] > far[i][0]:
                    far[i] = (float(d[i, k]), int(ids[k]), x[k].tolist())
        some = np.flatnonzero(n)
        found = [(None, int(k), int(n[k]), float(radius[k]), None) for k in some]
        found += [(i, None, f[1], f[0], f[2]) for i, f in enumerate(far) if f is not None]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64())]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)],
                                             names=["pivot", "leaf", "n", "size", "p"])

    return run


_MEASURED = "pivot int, leaf int, n bigint, size double, p array<double>"


def _far_points(points: DataFrame, tree: Tree, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Points and radius of every leaf, the pivots' farthest points and the largest distance seen."""
    seen = points.select("id", "p").mapInArrow(_measure(tuple(tree), pivots), _MEASURED)
    rows = seen.groupBy("pivot", "leaf").agg(
        F.sum(F.when(F.col("leaf").isNotNull(), F.col("n"))).alias("n"), F.max("size").alias("size"),
        F.max_by("p", F.struct("size", -F.col("n"))).alias("p")).collect()
    n, radius = np.zeros(len(tree.centres), np.int64), np.zeros(len(tree.centres))
    far, top = [], 0.0
    for r in rows:
        if r["leaf"] is not None:
            n[r["leaf"]], radius[r["leaf"]] = r["n"], r["size"]
        else:
            far.append(list(r["p"]))
            top = max(top, math.sqrt(r["size"]))
    return n, radius, np.array(far).reshape(len(far), tree.centres.shape[1]), top


def open_pairs(tree: Tree, n: np.ndarray, radius: np.ndarray, bound: float) -> list[tuple[int, int]]:
    """Leaf pairs that can hold a pair of points at ``bound`` or farther."""
    inner = 2 ** tree.depth - 1
    size = 2 * inner + 1
    centre, r = np.zeros((size, tree.centres.shape[1])), np.zeros(size)
    some = np.zeros(size, bool)
    centre[inner:], r[inner:], some[inner:] = tree.centres, radius, n > 0
    for node in range(inner - 1, -1, -1):  # a node's ball holds its children's
        a, b = 2 * node + 1, 2 * node + 2
        some[node] = some[a] or some[b]
        own = [c for c in (a, b) if some[c]]
        if own:
            centre[node] = centre[own].mean(axis=0)
            r[node] = max(math.sqrt(float(((centre[c] - centre[node]) ** 2).sum())) + r[c] for c in own)
    out, stack = [], [(0, 0)]
    while stack:
        a, b = stack.pop()
        if not (some[a] and some[b]):
            continue
        reach = 2 * r[a] if a == b else math.sqrt(float(((centre[a] - centre[b]) ** 2).sum())) + r[a] + r[b]
        if reach * (1 + SLACK) < bound:
            continue
        if a >= inner and b >= inner:
            out.append((min(a, b) - inner, max(a, b) - inner))
        elif a == b:
            x, y = 2 * a + 1, 2 * a + 2
            stack += [(x, x), (x, y), (y, y)]
        elif b >= inner or (a < inner and r[a] >= r[b]):
            stack += [(2 * a + 1, b), (2 * a + 2, b)]
        else:
            stack += [(a, 2 * b + 1), (a, 2 * b + 2)]
    return sorted(out)


def _copies(tree: tuple, partners: dict[int, list[int]], radius: np.ndarray, first: np.ndarray, bound: float):
    """``(bi, bj, blk, id, p)``: each point copied to the opened block pairs that it can decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tree(*tree)
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1), t.centres.shape[1])
            leaf = leaf_of(t, x)
            part = b.column(2).to_numpy()
            for here in np.unique(leaf):
                rows = np.flatnonzero(leaf == here)
                own = first[here] + part[rows] % (first[here + 1] - first[here])
                for other in partners.get(int(here), []):
                    reach = np.sqrt(((x[rows] - t.centres[other]) ** 2).sum(axis=1)) + radius[other]
                    can = reach * (1 + SLACK) >= bound
                    take, blk = rows[can], own[can]
                    if not len(take):
                        continue
                    batch = b.take(pa.array(take))
                    for block in range(first[other], first[other + 1]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.minimum(blk, block), pa.int32()), pa.array(np.maximum(blk, block), pa.int32()),
                             pa.array(blk, pa.int32()), batch.column(0), batch.column(1)],
                            names=["bi", "bj", "blk", "id", "p"])

    return run


def search(points: DataFrame, sample: list[tuple[int, list[float]]], n: int, dim: int) -> Search:
    """Branch and bound for the farthest pair of ``points (id, p)``: ``n`` finite points of width ``dim``;
    ``sample``: some of them (``sample_size`` says how many)."""
    x = np.array([p for _, p in sample], np.float64)
    rows = pairs.block_rows(dim)
    tree = build(x, leaf_count(n, dim))
    counts, radius, far, _ = _far_points(points, tree, x[:PIVOTS])
    *_, bound = _far_points(points, tree, far)
    opened = open_pairs(tree, counts, radius, bound * (1 - SLACK))
    some = int((counts > 0).sum())
    total = some * (some + 1) // 2
    if len(opened) >= OPEN_SHARE * total:
        return Search(None, some, total, len(opened),
                      f"{len(opened)} of {total} pairs of balls can hold the farthest pair: the points are not separable by balls")
    partners: dict[int, list[int]] = {}
    for a, b in opened:
        partners.setdefault(a, []).append(b)
        if a != b:
            partners.setdefault(b, []).append(a)
    blocks = np.maximum(1, -(-counts // rows))
    first = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
    groups = sum(int(blocks[a] * blocks[b]) if a != b else int(blocks[a] * (blocks[a] + 1) // 2) for a, b in opened)
    copies = sum(int(counts[a] * blocks[b]) for a in partners for b in partners[a])
    cores = points.sparkSession.sparkContext.defaultParallelism
    part = F.pmod(F.xxhash64("id"), F.lit(int(blocks.max()) * 1_000_003)).alias("part")
    dealt = points.select("id", "p", part).mapInArrow(
        _copies(tuple(tree), partners, radius, first, bound * (1 - SLACK)), "bi int, bj int, blk int, id bigint, p array<double>")
    dealt = dealt.repartition(pairs.task_count(max(1, groups), copies, dim, cores), "bi", "bj")
    best = dealt.groupBy("bi", "bj").applyInArrow(pairs._best_kernel(dim), "sqd double, i bigint, j bigint")
    return Search(best, some, total, len(opened), None)


def leaf_count(n: int, dim: int) -> int:
    """Leaves for ``n`` points: about half a block each."""
    return max(2, min(LEAVES_MAX, 2 ** math.ceil(math.log2(max(1.0, 2 * n / pairs.block_rows(dim))))))


def sample_size(n: int, dim: int) -> int:
    return max(PIVOTS, min(n, SAMPLE_CELLS // max(1, dim), SAMPLE_LEAF * leaf_count(n, dim)))
