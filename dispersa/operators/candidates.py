"""Farthest-first rounds by candidates: many rounds of all groups in one pass over the points.

A pass: every task computes its points' distances to their group's centres so far and keeps, per group, its
farthest points (candidates) and the best of what it does not keep (its bound). The candidates of a group meet
in one task, which runs rounds among them. A round's pick is right as long as it stands before every bound:
points that were not kept have a distance at the bound or below, and distances only shrink. The first pick of a
pass is always right, so ``k`` rounds take at most ``k`` passes, and one pass when all points are candidates.
The same path serves every size; only the share of points that are candidates follows it (``SUMMARY_CELLS``).

``merged_traversal`` is the other way to save passes, an approximation: centres of chunks, then centres of those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from dispersa.operators.pairs import BLOCK_CELLS, CELLS_PER_CHUNK, _Block, _matrix, _sqdist

SUMMARY_CELLS = 1 << 22   # coordinates of all candidates of a pass, about
BASE_ROWS = 64            # candidates of a task and group besides its share
BEFORE_ALL = -(1 << 62)   # id of a bound that only its distance is known of: stands before equal ones


def _before(a: tuple[float, int], b: tuple[float, int]) -> bool:
    """Whether point ``a`` is picked before ``b``: farther, or as far with a smaller id."""
    return a[0] > b[0] or (a[0] == b[0] and a[1] < b[1])


class _Kept:
    """Candidates of a task and group, and the bound on the other points."""

    def __init__(self, dim: int):
        self.ids, self.x, self.md = np.zeros(0, np.int64), np.zeros((0, dim)), np.zeros(0)
        self.seen = 0
        self.bound: tuple[float, int] | None = None

    def hold_back(self, md: float, row_id: int) -> None:
        if self.bound is None or _before((md, row_id), self.bound):
            self.bound = (md, row_id)

    def add(self, ids: np.ndarray, x: np.ndarray, centres: np.ndarray, limit: int) -> None:
        block = _Block(x, centres)
        near = np.empty(len(ids))
        step = max(1, CELLS_PER_CHUNK // max(1, len(centres)))
        for lo in range(0, len(ids), step):
            near[lo: lo + step] = block.approx(lo, min(len(ids), lo + step)).min(axis=1)
        if len(ids) > limit:  # approximate distances choose what is worth an exact one
            cut = np.partition(near, len(ids) - limit)[len(ids) - limit] - 2.0 * block.tol
            chosen = near >= cut
            if not chosen.all():
                self.hold_back(math.sqrt(max(cut + block.tol, 0.0)) * (1 + 1e-15), BEFORE_ALL)
            ids, x, near = ids[chosen], x[chosen], near[chosen]
        if block.gram:
            near = np.concatenate([_sqdist(x[lo: lo + step], centres).min(axis=1) for lo in range(0, len(ids), step)] or [near])
        self.ids, self.x = np.concatenate([self.ids, ids]), np.concatenate([self.x, x])
        self.md = np.concatenate([self.md, np.sqrt(near)])
        if len(self.ids) > limit:
            order = np.lexsort((self.ids, -self.md))
            first = order[limit]
            self.hold_back(float(self.md[first]), int(self.ids[first]))
            order = order[:limit]
            self.ids, self.x, self.md = self.ids[order], self.x[order], self.md[order]


def _lists(x: np.ndarray) -> pa.Array:
    ends = np.arange(len(x) + 1, dtype=np.int64) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.ascontiguousarray(x).ravel()))


def _groups(column: pa.Array) -> Iterator[tuple]:
    """``(value, rows)`` of each distinct value of a column, NULL too."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    coded = pc.dictionary_encode(column)
    codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    values = coded.dictionary.to_pylist()
    for code in np.unique(codes):
        yield (None if code < 0 else values[code]), np.flatnonzero(codes == code)


def _scan(dim: int, centres: dict, share: float, group_type: pa.DataType):
    """Arrow task over ``(group, id, p)``: candidates and bounds of the groups in ``centres``."""
    chosen = {g: np.array([i for i, _ in c], np.int64) for g, c in centres.items()}
    matrices = {g: np.array([p for _, p in c], np.float64).reshape(len(c), dim) for g, c in centres.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for batch in batches:
            ids, x = batch.column(1).to_numpy(), _matrix(batch.column(2), dim)
            for g, rows in _groups(batch.column(0)):
                if g not in matrices:
                    continue
                here = kept.setdefault(g, _Kept(dim))
                here.seen += len(rows)
                rows = rows[~np.isin(ids[rows], chosen[g])]
                if len(rows):
                    here.add(ids[rows], x[rows], matrices[g], BASE_ROWS + math.ceil(2 * share * here.seen))
        for g, here in kept.items():
            n, bound = len(here.ids), here.bound
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * n, group_type), pa.array(here.ids), _lists(here.x), pa.array(here.md),
                     pa.array([False] * n)], names=["g", "id", "p", "md", "held"])
            if bound is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g], group_type), pa.array([bound[1]], pa.int64()), pa.array([[]], pa.list_(pa.float64())),
                     pa.array([bound[0]]), pa.array([True])], names=["g", "id", "p", "md", "held"])

    return run


def _rounds(dim: int, k: int, have: dict):
    """Rounds among the candidates of one group, as far as the bounds let them be certain."""

    def run(key, table):
        group = key[0].as_py()
        held = table.column("held").to_numpy(zero_copy_only=False)
        ids, md = table.column("id").to_numpy(), table.column("md").to_numpy().copy()
        bound = None
        for at in np.flatnonzero(held):
            if bound is None or _before((md[at], ids[at]), bound):
                bound = (md[at], ids[at])
        ids, md = ids[~held], md[~held]
        x = _matrix(table.column("p").filter(pa.array(~held)), dim)
        steps, out = [], []
        left = np.ones(len(ids), bool)
        while len(steps) < k - have[group] and left.any():
            top = md[left].max()
            at = np.flatnonzero(left & (md == top))
            at = at[np.argmin(ids[at])]
            if out and bound is not None and not _before((top, ids[at]), bound):
                break
            steps.append(len(steps))
            out.append((at, top))
            left[at] = False
            md = np.minimum(md, np.sqrt(_sqdist(x, x[at: at + 1])[:, 0]))
        picked = np.array([at for at, _ in out], np.int64)
        return pa.table({
            "g": pa.array([group] * len(out), table.schema.field("g").type), "step": pa.array(steps, pa.int32()),
            "id": pa.array(ids[picked]), "p": _lists(x[picked]), "md": pa.array([float(d) for _, d in out], pa.float64())})

    return run


def traverse(points: DataFrame, k: int, first: dict, sizes: dict, dim: int, cache: bool) -> list[tuple]:
    """``(group, ord, id, p, min_dist)`` of the ``min(k, size)`` centres of every group of
    ``points (g, id, p)``; ``first``: each group's first centre ``(id, p)``. All centres pass through the
    driver, so the caller bounds their number. ``cache``: keep the points in memory from the second pass on."""
    kind = points.schema["g"].dataType.simpleString()
    arrow = to_arrow_type(points.schema["g"].dataType)
    found = {g: [(i, p, None)] for g, (i, p) in first.items()}
    n = sum(sizes.values())
    share = min(1.0, SUMMARY_CELLS / max(1, n * dim))
    held = False
    try:
        while open_groups := {g for g in found if len(found[g]) < min(k, sizes[g])}:
            centres = {g: [(i, p) for i, p, _ in found[g]] for g in open_groups}
            candidates = points.select("g", "id", "p").mapInArrow(
                _scan(dim, centres, share, arrow), f"g {kind}, id bigint, p array<double>, md double, held boolean")
            picks = candidates.groupBy("g").applyInArrow(
                _rounds(dim, k, {g: len(found[g]) for g in open_groups}),
                f"g {kind}, step int, id bigint, p array<double>, md double").collect()
            for r in sorted(picks, key=lambda r: r["step"]):
                found[r["g"]].append((r["id"], list(r["p"]), r["md"]))
            if cache and not held:
                points, held = points.persist(), True
    finally:
        if held:
            points.unpersist()
    return [(g, o, i, p, md) for g, c in found.items() for o, (i, p, md) in enumerate(c)]


def _local_centres(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[list[int], list[float | None]]:
    """Farthest-first traversal of one block from its smallest id: row numbers and distances."""
    at = int(np.argmin(ids))
    rows, far = [at], [None]
    md = np.full(len(ids), np.inf)
    left = np.ones(len(ids), bool)
    left[at] = False
    while len(rows) < k and left.any():
        md = np.minimum(md, np.sqrt(_sqdist(x, x[at: at + 1])[:, 0]))
        top = md[left].max()
        ties = np.flatnonzero(left & (md == top))
        at = int(ties[np.argmin(ids[ties])])
        rows.append(at)
        far.append(float(top))
        left[at] = False
    return rows, far


def _chunk_centres(k: int, with_order: bool):
    def run(key, table):
        ids = table.column("id").to_numpy()
        widths = pc.unique(pc.list_value_length(table.column("p"))).to_pylist()
        if len(widths) != 1:
            raise ValueError(f"point set mixes widths {sorted(widths, key=str)} (or a point is NULL)")
        x = _matrix(table.column("p"), widths[0])
        if not np.isfinite(x).all():
            raise ValueError("points hold NULL, NaN or infinite coordinates")
        rows, far = _local_centres(ids, x, k)
        part = pa.array([key[0].as_py()] * len(rows), table.schema.field("part").type)
        if not with_order:
            return pa.table({"part": part, "id": ids[rows], "p": _lists(x[rows])})
        return pa.table({"part": part, "ord": pa.array(range(len(rows)), pa.int32()), "id": ids[rows],
                         "p": _lists(x[rows]), "min_dist": pa.array(far, pa.float64())})

    return run


def merged_traversal(points: DataFrame, k: int, chunk_of: Column) -> DataFrame:
    """``(part, ord, id, p, min_dist)``: centres of each part of ``points (part, id, p)`` in one job whatever
    ``k``. Each chunk of a part gives its own ``k`` farthest-first centres (a mergeable summary:
    the union of two chunks' summaries is the summary of both), and the traversal of the chunks' centres
    gives the part's.

    Every point is within ``2 * opt`` of a centre of its chunk, and that centre within ``2 * opt`` of one of the
    part's (``opt``: the best radius of any ``k`` points), so the covering radius is at most 4 times the best
    and 4 times that of the exact traversal. ``chunk_of`` maps a row to a chunk number; chunks should hold at
    most BLOCK_CELLS coordinates. Ties go to the smallest id, and the result does not depend on how rows are
    placed.
    """
    kind = points.schema["part"].dataType.simpleString()
    small = points.select("part", chunk_of.alias("chunk"), "id", "p").groupBy("part", "chunk").applyInArrow(
        _chunk_centres(k, False), f"part {kind}, id bigint, p array<double>")
    return small.groupBy("part").applyInArrow(
        _chunk_centres(k, True), f"part {kind}, ord int, id bigint, p array<double>, min_dist double")


def chunk_count(n: int, dim: int, L: int) -> int:
    """Chunks of a part, so that a chunk of ``n`` points in ``L`` like parts is within BLOCK_CELLS."""
    return max(1, math.ceil(n * max(1, dim) / (L * BLOCK_CELLS // 2)))

