"""Farthest pair of 2-d points by convex hulls: hull per task, hulls merged, rotating calipers on the last one.

Only points on the border of the hull can end a farthest pair. A task keeps what may be on the border of its
points, tasks' points meet in fewer tasks that do the same (two merge levels; the exchange between them is
sized by Spark from what is left, so it is one small task for a small set), and the last task runs calipers.

Exact in floating point, ties included. A point ``p`` is dropped only if a chord of the hull goes through it
with both parts ``s``, ``r`` large: for any ``q``, ``|q-p|^2 <= max(|q-a|^2, |q-b|^2) - s*r`` over the chord's
ends ``a``, ``b``, so with ``s*r >= SLACK * extent^2`` no rounding lets ``p`` tie the farthest pair. Tested are
the chords along and across the set's long axis and the hull's edges. Calipers give the near-farthest antipodal
pairs; all kept points near such a pair's two support lines are compared exactly, summed like everywhere.

A NaN coordinate never wins. ``farthest_pair`` returns None, and the caller takes the general kernel, for
infinite or extreme coordinates and for sets with more than ``BORDER_MAX`` points left on the border.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispersa.operators.pairs import _matrix

BORDER_MAX = 1 << 16     # points a merged hull may have
DIRECTIONS = 32          # extreme points in so many directions make the first, inner polygon
SLACK = 1e-9             # product of a chord's parts (extents are 1) from which a point is dropped
ON_EDGE = 1e-12          # distance from an edge within which a point counts as on it
NEAR = 1e-8              # antipodal pairs this close to the best, and points this close to their support lines


def hull_of(x: np.ndarray) -> np.ndarray:
    """Row numbers of the strict hull vertices, counter-clockwise from the lowest leftmost point."""
    order = np.lexsort((x[:, 1], x[:, 0]))
    pts = x[order].tolist()

    def chain(indices):
        out: list[int] = []
        for i in indices:
            px, py = pts[i]
            while len(out) >= 2:
                (ax, ay), (bx, by) = pts[out[-2]], pts[out[-1]]
                if (bx - ax) * (py - ay) - (by - ay) * (px - ax) > 0:
                    break
                out.pop()
            if not out or pts[out[-1]] != pts[i]:
                out.append(i)
        return out

    lower, upper = chain(range(len(pts))), chain(range(len(pts) - 1, -1, -1))
    return order[np.array(lower[:-1] + upper[:-1] if len(lower) > 1 else lower)]


def _chains(poly: np.ndarray, axis: int) -> list[np.ndarray]:
    """The polygon's two borders as functions of coordinate ``axis``, both in rising order."""
    lo, hi = int(np.argmin(poly[:, axis])), int(np.argmax(poly[:, axis]))
    turn = np.roll(poly, -lo, axis=0)
    hi = (hi - lo) % len(poly)
    return [turn[: hi + 1], np.vstack([turn[hi:], turn[:1]])[::-1]]


def _inside(x: np.ndarray, poly: np.ndarray) -> np.ndarray:
    """Points that a long chord of ``poly`` proves to be no end of a farthest pair (extents about 1)."""
    out = np.zeros(len(x), bool)
    if len(poly) == 1:
        return out
    for axis in (0, 1):
        other = 1 - axis
        if np.ptp(poly[:, axis]) <= ON_EDGE:
            continue
        ends = []
        for border in _chains(poly, axis):
            steps = np.concatenate([[True], np.diff(border[:, axis]) > 0])
            border = border[steps]
            if len(border) < 2:
                ends = []
                break
            at = np.clip(np.searchsorted(border[:, axis], x[:, axis]), 1, len(border) - 1)
            a, b = border[at - 1], border[at]
            edge = b - a
            t = np.clip((x[:, axis] - a[:, axis]) / edge[:, axis], 0.0, 1.0)
            ends.append(a[:, other] + t * edge[:, other])
            length = np.hypot(edge[:, 0], edge[:, 1])
            off = np.abs(edge[:, 0] * (x[:, 1] - a[:, 1]) - edge[:, 1] * (x[:, 0] - a[:, 0])) / length
            along = ((x - a) * edge).sum(axis=1) / length
            out |= (off <= ON_EDGE) & (along > 0) & (along < length) & (along * (length - along) >= SLACK)
        within = (x[:, axis] >= poly[:, axis].min()) & (x[:, axis] <= poly[:, axis].max())
        if len(ends) == 2:
            low, high = np.minimum(*ends), np.maximum(*ends)
            out |= within & (x[:, other] > low) & (x[:, other] < high) & ((x[:, other] - low) * (high - x[:, other]) >= SLACK)
    return out


def border(x: np.ndarray) -> np.ndarray:
    """Mask of the points that may end a farthest pair."""
    keep = np.ones(len(x), bool)
    if len(x) < 8:
        return keep
    x = x - x[0]
    extent = np.abs(x).max()
    if extent == 0:
        return keep
    x = x / extent
    angle = np.arange(DIRECTIONS) * (2 * math.pi / DIRECTIONS)
    tops = np.unique(np.argmax(x @ np.vstack([np.cos(angle), np.sin(angle)]), axis=0))
    inner = x[tops]
    gaps = ((inner[:, None, :] - inner[None, :, :]) ** 2).sum(axis=2)
    a, b = np.unravel_index(np.argmax(gaps), gaps.shape)
    axis = inner[b] - inner[a]
    size = math.sqrt(float(axis @ axis))
    if size == 0:
        return keep
    ux, uy = axis / size
    turned = (x - inner[a]) @ np.array([[ux, -uy], [uy, ux]]) / size  # long axis first, its extent about 1
    keep = ~_inside(turned, turned[tops][hull_of(turned[tops])])
    left = np.flatnonzero(keep)
    polygon = turned[left][hull_of(turned[left])]
    keep[left] &= ~_inside(turned[left], polygon)
    return keep


def _two_of_each(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Rows of the two smallest ids at every place (two, as all points may be at one place)."""
    order = np.lexsort((ids, x[:, 1], x[:, 0]))
    s = x[order]
    same = np.zeros(len(s), bool)
    same[1:] = (s[1:] == s[:-1]).all(axis=1)
    third = same.copy()
    third[1:] &= same[:-1]
    third[:1] = False
    return order[~third]


class _Border:
    """Points of a stream that may be on the border; ``ok`` is False once there are too many or extreme ones."""

    def __init__(self):
        self.ids, self.x, self.ok, self.limit = np.zeros(0, np.int64), np.zeros((0, 2)), True, BORDER_MAX

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        fine = ~np.isnan(x).any(axis=1)
        ids, x = ids[fine], x[fine]
        size = np.abs(x)
        if size.max(initial=0.0) > 1e150:
            self.ok = False
        if not self.ok:
            return
        self.ids, self.x = np.concatenate([self.ids, ids]), np.concatenate([self.x, x])
        if len(self.ids) > self.limit:
            self.reduce()

    def reduce(self) -> None:
        if not self.ok or not len(self.ids):
            return
        spread = np.abs(self.x - self.x[0]).max()
        if 0 < spread < 1e-140:
            self.ok = False
            return
        at = np.flatnonzero(border(self.x))
        at = at[_two_of_each(self.ids[at], self.x[at])]
        self.ids, self.x = self.ids[at], self.x[at]
        if len(at) > BORDER_MAX:
            self.ok = False
        self.limit = max(BORDER_MAX, 2 * len(at))


def _batches(batches, has_flag: bool) -> _Border:
    kept = _Border()
    for b in batches:
        if has_flag and not pc.all(b.column(2)).as_py():
            kept.ok = False
        kept.add(b.column(0).to_numpy(), _matrix(b.column(1), 2) if b.num_rows else np.zeros((0, 2)))
        if not kept.ok:
            break
    kept.reduce()
    return kept


def _reduce(has_flag: bool):
    def run(batches):
        kept = _batches(batches, has_flag)
        if not kept.ok:
            yield pa.RecordBatch.from_pydict({"id": pa.array([0], pa.int64()), "p": [[0.0, 0.0]], "ok": [False]})
        elif len(kept.ids):
            ends = pa.array(np.arange(len(kept.ids) + 1, dtype=np.int32) * 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept.ids), pa.ListArray.from_arrays(ends, pa.array(kept.x.ravel())),
                 pa.array(np.ones(len(kept.ids), bool))], names=["id", "p", "ok"])

    return run


def _sq(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    dx, dy = a[..., 0] - b[..., 0], a[..., 1] - b[..., 1]
    return dx * dx + dy * dy


def antipodal(poly: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that contain every antipodal pair of a convex polygon: rotating calipers over all edges."""
    n = len(poly)
    edges = np.roll(poly, -1, axis=0) - poly
    angle = np.unwrap(np.arctan2(edges[:, 1], edges[:, 0]))
    angle = np.maximum.accumulate(angle)  # rising by at most a turn; rounding may have bent it
    opposite = angle[0] + (angle + math.pi - angle[0]) % (2 * math.pi)
    across = np.searchsorted(angle, opposite) % n   # the vertex that the other caliper touches
    i = np.repeat(np.arange(n), 6)
    steps = np.tile([(a, b) for a in (0, 1) for b in (-1, 0, 1)], (n, 1))
    return (i + steps[:, 0]) % n, (np.repeat(across, 6) + steps[:, 1]) % n


def calipers(ids: np.ndarray, x: np.ndarray) -> tuple[float, int, int] | None:
    """``(sqdist, i, j)`` of the farthest pair among border points; ties: smallest ``(i, j)``."""
    if len(ids) < 2:
        return None
    if len(ids) <= 512:
        groups = [(np.arange(len(ids)), np.arange(len(ids)))]
    else:
        polygon = hull_of(x)
        a, b = antipodal(x[polygon])
        width = np.sqrt(_sq(x[polygon[a]], x[polygon[b]]))
        best = width.max()
        if best == 0:
            groups = [(np.arange(len(ids)), np.arange(len(ids)))]
        else:
            near = np.flatnonzero(width >= best * (1 - NEAR))
            seen, groups = set(), []
            for k in near:
                ends = tuple(sorted((int(a[k]), int(b[k]))))
                if ends in seen:
                    continue
                seen.add(ends)
                p, q = x[polygon[ends[0]]], x[polygon[ends[1]]]
                u = (q - p) / math.sqrt(float(_sq(p, q)))
                groups.append((np.flatnonzero((x - p) @ u <= NEAR * best), np.flatnonzero((q - x) @ u <= NEAR * best)))
    best = None
    for rows, cols in groups:
        step = max(1, (1 << 20) // max(1, len(cols)))
        for lo in range(0, len(rows), step):
            r = rows[lo: lo + step]
            d = _sq(x[r][:, None, :], x[cols][None, :, :])
            d[ids[r][:, None] == ids[cols][None, :]] = -np.inf
            top = d.max(initial=-np.inf)
            if top == -np.inf or (best is not None and top < best[0]):
                continue
            i, j = np.nonzero(d == top)
            low, high = np.minimum(ids[r[i]], ids[cols[j]]), np.maximum(ids[r[i]], ids[cols[j]])
            at = np.lexsort((high, low))[0]
            found = (float(top), int(low[at]), int(high[at]))
            if best is None or found[0] > best[0] or found[1:] < best[1:]:
                best = found
    return best


def _finish(batches):
    kept = _batches(batches, True)
    best = calipers(kept.ids, kept.x) if kept.ok else None
    sqd, i, j = best or (None, None, None)
    yield pa.RecordBatch.from_pydict({
        "ok": pa.array([kept.ok]), "border": pa.array([len(kept.ids)], pa.int64()), "sqd": pa.array([sqd], pa.float64()),
        "i": pa.array([i], pa.int64()), "j": pa.array([j], pa.int64())})


def border_points(points: DataFrame) -> DataFrame:
    """``(id, p, ok)``: the points of 2-d ``points (id, p)`` that may be on the hull's border, after each task's
    own hull and a first merge. ``ok`` is False in a row that stands for points that were given up on."""
    kind = "id bigint, p array<double>, ok boolean"
    first = points.select("id", "p").mapInArrow(_reduce(False), kind)
    return first.repartition(F.pmod(F.xxhash64("id"), F.lit(256))).mapInArrow(_reduce(True), kind)


def farthest_pair(points: DataFrame) -> tuple[float, int, int] | None | bool:
    """``(sqdist, i, j)`` of the farthest pair of 2-d points; None without a pair; False if the hull cannot
    settle it (see the module docstring)."""
    row = border_points(points).repartition(1).mapInArrow(
        _finish, "ok boolean, border bigint, sqd double, i bigint, j bigint").first()
    if not row["ok"]:
        return False
    return None if row["sqd"] is None else (row["sqd"], row["i"], row["j"])
