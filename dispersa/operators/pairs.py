"""All-pairs work over a point set without a cross join and without emitting pairs.

Points are hashed into ``B`` blocks by id. Every point is copied to the ``B`` block pairs
``(min(b, c), max(b, c))`` it takes part in, the copies are hash-partitioned by block pair,
and each block pair is reduced by a small Arrow function that computes the distances
between its two blocks with NumPy and returns only a summary:

* ``best``: the farthest pair of the block pair (ties: smallest ``(i, j)`` ids),
* ``sum``: the sum of the distances and the number of pairs,
* ``partners``: for every point its ``m`` farthest partners in the other block.

``cross_blocks`` does the same between two sets (points and a large sample or centre
set): each side is hashed into blocks and copied to the other side's blocks.

Each pair of distinct points is seen by exactly one block pair. A group holds two blocks,
about ``2n/B`` points, so no group grows with the data beyond the block size, and ids
are hashed, so a heavy group of duplicate points is spread like any other.

Results are exact: every squared distance that decides an answer is accumulated
coordinate by coordinate from 0, the same order as a sequential loop, so it is
bit-identical to the built-in expressions in ``dispersa.functions.distance``. From width
``GRAM_MIN_DIM`` up, a BLAS Gram product first bounds all distances of a block pair
(error below a proven ``tol``), and only the entries that can still matter are recomputed
that way.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from dispersa.functions.distance import point_stats, sqdist

MAX_BLOCK = 8192        # points per block at most: bounds a group's run time; n*B copies are
                        # shuffled, so larger blocks mean less replication
BLOCK_CELLS = 1 << 20   # coordinates per block at most (8 MB): bounds a group's memory at any width
TASK_CELLS = 1 << 24    # coordinates of copies that one task reads (128 MB)
MIN_BLOCK = 64          # below this, NumPy call overhead dominates
CELLS_PER_CHUNK = 1 << 20   # distance-matrix cells computed at once
GRAM_MIN_DIM = 8            # from this width up, candidates come from one BLAS product


def block_rows(dim: int) -> int:
    """Points per block at most, for points of width ``dim``."""
    return max(1, min(MAX_BLOCK, BLOCK_CELLS // max(1, dim)))


def task_count(groups: int, copies: int, dim: int, parallelism: int) -> int:
    """Partitions of the copies: by their size, and at least two per core, but never more than groups."""
    return max(1, min(groups, max(2 * parallelism, math.ceil(copies * max(1, dim) / TASK_CELLS))))


def block_count(n: int, dim: int, parallelism: int) -> int:
    """Blocks for ``n`` points: enough for ~4 block pairs per core, never blocks above ``block_rows``."""
    if n <= 1:
        return 1
    by_size = math.ceil(n / block_rows(dim))
    by_cores = math.ceil(math.sqrt(8 * max(1, parallelism)))
    return max(1, by_size, min(by_cores, math.ceil(n / MIN_BLOCK)))


def _matrix(col, dim: int) -> np.ndarray:
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if len(arr) == 0:
        return np.zeros((0, dim))
    lengths = pc.list_value_length(arr)
    if pc.min(lengths).as_py() != dim or pc.max(lengths).as_py() != dim or arr.null_count:
        raise ValueError(f"point widths differ from the set's width {dim} (or a point is NULL)")
    flat = pc.list_flatten(arr).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(arr), dim)


def _sqdist(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances, summed coordinate by coordinate from 0."""
    out = np.zeros((a.shape[0], b.shape[0]))
    for t in range(a.shape[1]):
        diff = a[:, t, None] - b[None, :, t]
        out += diff * diff
    return out


def _sqdist_at(a: np.ndarray, b: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the index pairs ``(a[r], b[c])``, same summation order."""
    out = np.zeros(len(r))
    for t in range(a.shape[1]):
        diff = a[r, t] - b[c, t]
        out += diff * diff
    return out


class _Block:
    """Distances between two blocks. From width GRAM_MIN_DIM up, ``approx`` uses the Gram
    form ``|a|^2 + |b|^2 - 2ab`` (one BLAS product, ~25x faster at width 64) and ``tol``
    bounds its error, so callers select candidates with it and recompute those exactly;
    in lower widths ``approx`` is exact and ``tol`` is 0."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a, b
        self.gram = a.shape[1] >= GRAM_MIN_DIM
        if self.gram:
            self.na = np.einsum("ij,ij->i", a, a)
            self.nb = np.einsum("ij,ij->i", b, b)
            # NaN or infinite coordinates: no usable bound, take the exact loop instead.
            self.gram = bool(np.isfinite(self.na).all() and np.isfinite(self.nb).all())
        if self.gram:
            self.bt = np.ascontiguousarray(b.T)
            eps = np.finfo(np.float64).eps
            top = (self.na.max(initial=0.0) if len(a) else 0.0) + (self.nb.max(initial=0.0) if len(b) else 0.0)
            self.tol = 4.0 * (2 * a.shape[1] + 8) * eps * top
        else:
            self.tol = 0.0

    def approx(self, lo: int, hi: int) -> np.ndarray:
        if not self.gram:
            return _sqdist(self.a[lo:hi], self.b)
        # In place, no temporaries (a third faster than the plain expression); the
        # operation order is covered by `tol` like any other.
        g = self.a[lo:hi] @ self.bt
        g *= -2.0
        g += self.na[lo:hi, None]
        g += self.nb[None, :]
        return g

    def exact(self, lo: int, r: np.ndarray, c: np.ndarray, approx: np.ndarray) -> np.ndarray:
        if not self.gram:
            return approx[r, c]
        return _sqdist_at(self.a, self.b, lo + r, c)


def _chunks(rows: int, cols: int):
    step = max(1, CELLS_PER_CHUNK // max(1, cols))
    for lo in range(0, rows, step):
        yield lo, min(rows, lo + step)


def _sides(key, table: pa.Table, dim: int):
    """The two blocks of a group: (ids_a, X_a, ids_b, X_b, same_block)."""
    bi, bj = key[0].as_py(), key[1].as_py()
    ids = table.column("id").to_numpy()
    blk = table.column("blk").to_numpy()
    X = _matrix(table.column("p"), dim)
    if bi == bj:
        return ids, X, ids, X, True
    ma, mb = blk == bi, blk == bj
    return ids[ma], X[ma], ids[mb], X[mb], False


def _best_kernel(dim: int):
    def kernel(key, table):
        ia, xa, ib, xb, same = _sides(key, table, dim)
        blk = _Block(xa, xb)
        best = None  # (sqd, lo_id, hi_id)
        for lo, hi in _chunks(len(ia), len(ib)):
            d = blk.approx(lo, hi)
            d[np.isnan(d)] = -np.inf
            if same:
                d[np.arange(len(ib))[None, :] <= np.arange(lo, hi)[:, None]] = -np.inf
            m = d.max() if d.size else -np.inf
            if m == -np.inf:
                continue
            # Every entry that can still be the exact maximum (and every tie) is within 2 tol.
            r, c = np.nonzero(d >= m - 2.0 * blk.tol)
            ex = blk.exact(lo, r, c, d)
            top = ex.max()
            keep = ex == top
            a_ids, b_ids = ia[lo + r[keep]], ib[c[keep]]
            p_lo, p_hi = np.minimum(a_ids, b_ids), np.maximum(a_ids, b_ids)
            t = np.lexsort((p_hi, p_lo))[0]
            cand = (float(top), int(p_lo[t]), int(p_hi[t]))
            if best is None or cand[0] > best[0] or (cand[0] == best[0] and cand[1:] < best[1:]):
                best = cand
        if best is None:
            return pa.table({"sqd": pa.array([], pa.float64()), "i": pa.array([], pa.int64()),
                             "j": pa.array([], pa.int64())})
        return pa.table({"sqd": [best[0]], "i": [best[1]], "j": [best[2]]})

    return kernel


def _sum_kernel(dim: int):
    def kernel(key, table):
        ia, xa, ib, xb, same = _sides(key, table, dim)
        blk = _Block(xa, xb)
        total, count = 0.0, 0
        for lo, hi in _chunks(len(ia), len(ib)):
            d = blk.approx(lo, hi)
            if blk.gram:
                # Where cancellation could cost more than ~1e-10 relative, recompute exactly.
                r, c = np.nonzero(d < 1e10 * blk.tol)
                d[r, c] = blk.exact(lo, r, c, d)
            d = np.sqrt(np.maximum(d, 0.0)) if blk.gram else np.sqrt(d)
            if same:
                keep = np.arange(len(ib))[None, :] > np.arange(lo, hi)[:, None]
                total += float(d[keep].sum())
                count += int(keep.sum())
            else:
                total += float(d.sum())
                count += d.size
        return pa.table({"sum_dist": [total], "n_pairs": pa.array([count], pa.int64())})

    return kernel


def _partner_kernel(dim: int, m: int):
    def top(ids_rows, x_rows, ids_cols, x_cols, exclude_self):
        blk = _Block(x_rows, x_cols)
        out_i, out_j, out_d = [], [], []
        for lo, hi in _chunks(len(ids_rows), len(ids_cols)):
            d = blk.approx(lo, hi)
            d[np.isnan(d)] = -np.inf
            if exclude_self:
                d[ids_rows[lo:hi, None] == ids_cols[None, :]] = -np.inf
            # Per row, every entry that can be in the exact top m (ties included) lies
            # within 2 tol of the row's m-th largest approximate value.
            if d.shape[1] > m:
                thr = np.partition(d, d.shape[1] - m, axis=1)[:, d.shape[1] - m]
            else:
                thr = np.full(d.shape[0], -np.inf)
            r, c = np.nonzero((d >= (thr - 2.0 * blk.tol)[:, None]) & (d > -np.inf))
            ex = blk.exact(lo, r, c, d)
            order = np.lexsort((ids_cols[c], -ex, r))
            r, c, ex = r[order], c[order], ex[order]
            first = np.searchsorted(r, r, side="left")
            keep = (np.arange(len(r)) - first) < m
            out_i.append(ids_rows[lo + r[keep]])
            out_j.append(ids_cols[c[keep]])
            out_d.append(ex[keep])
        return out_i, out_j, out_d

    def kernel(key, table):
        ia, xa, ib, xb, same = _sides(key, table, dim)
        parts = [top(ia, xa, ib, xb, same)]
        if not same:
            parts.append(top(ib, xb, ia, xa, False))
        cat = lambda k, dt: np.concatenate([a for p in parts for a in p[k]] or [np.zeros(0, dt)])
        return pa.table({"i": cat(0, np.int64), "j": cat(1, np.int64), "sqd": cat(2, np.float64)})

    return kernel


_SCHEMAS = {
    "best": "sqd double, i bigint, j bigint",
    "sum": "sum_dist double, n_pairs bigint",
    "partners": "i bigint, j bigint, sqd double",
}


def block_pairs(points: DataFrame, mode: str, m: int = 1, stats: dict | None = None) -> DataFrame:
    """Run one kernel over all block pairs of ``points (id, p)``; returns the per-group summaries."""
    stats = stats or point_stats(points)
    n, dim = stats["n"], stats["dim"]
    spark = points.sparkSession
    parallelism = spark.sparkContext.defaultParallelism
    B = block_count(n, dim, parallelism)
    groups = B * (B + 1) // 2
    blk = F.pmod(F.xxhash64("id"), F.lit(B)).cast("int")
    copies = (
        points.select("id", "p", blk.alias("blk"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(B - 1))))
        .select(F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"), "blk", "id", "p")
        # Explicit count: AQE must not coalesce these byte-small but CPU-heavy groups.
        .repartition(task_count(groups, n * B, dim, parallelism), "bi", "bj")
    )
    kernel = {"best": _best_kernel, "sum": _sum_kernel}.get(mode)
    fn = kernel(dim) if kernel else _partner_kernel(dim, m)
    return copies.groupBy("bi", "bj").applyInArrow(fn, _SCHEMAS[mode])


def _cross_kernel(dim: int, mode: str):
    """Set block x point block: ``max`` (one row), ``min`` (per point) or ``all`` distances."""

    def kernel(key, table):
        side = table.column("side").to_numpy()
        ids = table.column("id").to_numpy()
        X = _matrix(table.column("p"), dim)
        ip, xp, iset, xset = ids[side == 0], X[side == 0], ids[side == 1], X[side == 1]
        blk = _Block(xp, xset)
        outs = []
        for lo, hi in _chunks(len(ip), len(iset)):
            d = blk.approx(lo, hi)
            if mode == "max":
                d[np.isnan(d)] = -np.inf
                m = d.max() if d.size else -np.inf
                if m > -np.inf:
                    r, c = np.nonzero(d >= m - 2.0 * blk.tol)
                    outs.append(blk.exact(lo, r, c, d).max())
            elif mode == "min":
                d[np.isnan(d)] = np.inf
                if d.shape[1] == 0:
                    continue
                m = d.min(axis=1)
                # Candidates within 2 tol of each row's approximate minimum, decided exactly.
                r, c = np.nonzero(d <= (m + 2.0 * blk.tol)[:, None])
                ex = blk.exact(lo, r, c, d)
                best = np.full(hi - lo, np.inf)
                np.minimum.at(best, r, ex)
                best[np.isinf(best) & np.isinf(m)] = np.nan
                outs.append((ip[lo:hi], best))
            else:
                r, c = np.nonzero(np.ones_like(d, dtype=bool))
                outs.append((iset[c], ip[lo + r], _sqdist_at(xp, xset, lo + r, c)))
        if mode == "max":
            return pa.table({"sqd": pa.array([max(outs)] if outs else [], pa.float64())})
        if mode == "min":
            cat = lambda k, dt: np.concatenate([o[k] for o in outs] or [np.zeros(0, dt)])
            return pa.table({"id": cat(0, np.int64), "sqd": cat(1, np.float64)})
        cat = lambda k, dt: np.concatenate([o[k] for o in outs] or [np.zeros(0, dt)])
        return pa.table({"i": cat(0, np.int64), "j": cat(1, np.int64), "sqd": cat(2, np.float64)})

    return kernel


_CROSS_SCHEMAS = {"max": "sqd double", "min": "id bigint, sqd double", "all": "i bigint, j bigint, sqd double"}


def cross_blocks(points: DataFrame, others: DataFrame, mode: str, n: int, k: int, dim: int) -> DataFrame:
    """All distances between ``points`` and a second, possibly large, set ``others``
    (both ``(id, p)``; ``n`` and ``k`` rows) without a cross join: points are hashed into
    ``Bp`` blocks and the set into ``Bs`` blocks, each side is copied to the other's
    blocks, and every ``(bp, bs)`` group is reduced in NumPy. Groups hold at most
    ``block_rows(dim)`` points of each side. ``min`` returns one row per point and group (take
    the minimum per ``id`` afterwards); ``max`` one row per group; ``all`` every distance.
    """
    spark = points.sparkSession
    parallelism = spark.sparkContext.defaultParallelism
    rows = block_rows(dim)
    Bs = max(1, math.ceil(k / rows))
    Bp = max(1, math.ceil(n / rows), min(math.ceil(4 * parallelism / Bs), math.ceil(n / MIN_BLOCK)))
    p_side = points.select(
        F.explode(F.sequence(F.lit(0), F.lit(Bs - 1))).alias("bs"),
        F.pmod(F.xxhash64("id"), F.lit(Bp)).cast("int").alias("bp"), F.lit(0).alias("side"), "id", "p")
    s_side = others.select(
        F.pmod(F.xxhash64("id"), F.lit(Bs)).cast("int").alias("bs"),
        F.explode(F.sequence(F.lit(0), F.lit(Bp - 1))).alias("bp"), F.lit(1).alias("side"), "id", "p")
    copies = p_side.unionByName(s_side).repartition(
        task_count(Bp * Bs, n * Bs + k * Bp, dim, parallelism), "bp", "bs")
    return copies.groupBy("bp", "bs").applyInArrow(_cross_kernel(dim, mode), _CROSS_SCHEMAS[mode])


def farthest_pair(points: DataFrame, stats: dict | None = None) -> DataFrame:
    """``(i, j, sqdist, dist)``: the farthest pair, ``i < j``; ties go to the smallest ``(i, j)``.

    No row when fewer than two points (or only NaN distances) exist.
    """
    return best_of(block_pairs(points, "best", stats=stats))


def best_of(best: DataFrame) -> DataFrame:
    """``(i, j, sqdist, dist)``: the first of the rows ``(sqd, i, j)``."""
    top = best.agg(
        F.max_by(F.struct("i", "j", "sqd"), F.struct("sqd", -F.col("i"), -F.col("j"))).alias("b")
    )
    return top.where(F.col("b").isNotNull()).select(
        F.col("b.i").alias("i"), F.col("b.j").alias("j"), F.col("b.sqd").alias("sqdist"),
        F.sqrt("b.sqd").alias("dist"),
    )


def exact_diameter(points: DataFrame, stats: dict | None = None) -> DataFrame:
    """``(max_dist)``: largest distance over all pairs; 0 for fewer than two points."""
    best = block_pairs(points, "best", stats=stats)
    return best.agg(F.coalesce(F.sqrt(F.max("sqd")), F.lit(0.0)).alias("max_dist"))


def average_pairwise_distance(points: DataFrame, stats: dict | None = None) -> DataFrame:
    """``(avg_dist)``: mean distance over unordered pairs; NULL for fewer than two points
    (the reference divides 0 by 0)."""
    parts = block_pairs(points, "sum", stats=stats)
    return parts.agg((F.sum("sum_dist") / F.nullif(F.sum("n_pairs"), F.lit(0))).alias("avg_dist"))


ESTIMATE_GROUP = 1024   # points that a task orders to draw pairs among them


def estimate_average_distance(points: DataFrame, rounds: int = 4, seed: int = 0, delta: float = 1e-6,
                              n: int | None = None) -> DataFrame:
    """``(avg_dist, error_bound, n_pairs)``: an estimate of ``average_pairwise_distance`` from ``rounds`` random
    matchings, at ``rounds * n`` distances instead of ``n^2 / 2``.

    Each round deals the points to groups by the MD5 of seed, round and id, and pairs neighbours in the order of
    that MD5 within a group. Given the groups' sizes every matching is as likely as any other, so the mean over
    a round's ``m`` pairs is unbiased, and moving one point changes it by at most ``2R / m`` (``R``: twice the
    farthest distance from the point with the smallest id, above any distance). By Azuma's inequality it is
    within ``error_bound = R * sqrt(8 n ln(2/delta)) / m`` of the exact mean but for a chance of ``delta``; the
    mean of the rounds keeps the bound. Repeatable, and independent of the rows' placement. NULL columns for
    fewer than two points. Points of mixed widths, NULL points or coordinates are an error.
    """
    if rounds < 1 or not 0 < delta < 1:
        raise ValueError("rounds must be >= 1 and delta between 0 and 1")
    stats = point_stats(points)
    n, dim = stats["n"], stats["dim"]
    if stats["nans"]:
        raise ValueError(f"{stats['nans']} point(s) hold NULL, NaN or infinite coordinates")
    if n < 2:
        return points.sparkSession.createDataFrame([(None, None, 0)], "avg_dist double, error_bound double, n_pairs bigint")
    start = points.agg(F.min_by("p", "id").alias("p")).first()["p"]
    groups = -(-n // ESTIMATE_GROUP)
    copies = points.select("id", "p", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("t"))
    key = F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col("t").cast("string"), F.lit(":"), F.col("id").cast("string")))
    copies = copies.withColumn("key", key).withColumn(
        "grp", F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint") % F.lit(groups))
    order = Window.partitionBy("t", "grp").orderBy("key", "id")
    drawn = copies.select("t", "p", F.lead("p").over(order).alias("q"), F.row_number().over(order).alias("at")).where(
        "at % 2 = 1 AND q IS NOT NULL").select("t", F.sqrt(sqdist("p", "q", dim)).alias("d"))
    by_round = drawn.groupBy("t").agg(F.avg("d").alias("mean"), F.count(F.lit(1)).alias("m"))
    whole = by_round.agg(F.avg("mean").alias("avg_dist"), F.min("m").alias("m"), F.sum("m").alias("n_pairs"))
    reach = points.agg((2 * F.max(F.sqrt(sqdist("p", list(start), dim)))).alias("r")).first()["r"]
    bound = F.lit(reach * math.sqrt(8 * n * math.log(2 / delta))) / F.col("m")
    return whole.select("avg_dist", bound.alias("error_bound"), "n_pairs")


def top_partners(points: DataFrame, m: int, stats: dict | None = None) -> DataFrame:
    """``(i, j, sqd)``: for every point ``i`` its ``m`` farthest other points ``j``
    (ties: smaller ``j`` first). Each point's list is merged from its ``B`` block pairs,
    so the window below sees at most ``B*m`` rows per point."""
    if m < 1:
        raise ValueError("m must be >= 1")
    cand = block_pairs(points, "partners", m=m, stats=stats)
    w = Window.partitionBy("i").orderBy(F.col("sqd").desc(), F.col("j").asc())
    return cand.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= m).drop("rk")
