"""Diameter (maximum pairwise distance) of a point set: exact, sampled and k-center based.

* ``exact_diameter``: every pair, via the block-pair kernel (``dispersa.operators.pairs``).
* ``sampled_diameter``: ``k`` sample points against all points; a 2-approximation
  (``D/2 <= result <= D``). The sample is the ``k`` smallest ids in a seeded hash order:
  without replacement, where the reference draws with replacement; a repeated draw
  never raises the maximum, so this is never worse.
* ``k_center_diameter``: exact diameter of the ``k`` farthest-first centres.

Distances from every point to a set of points (the sample, or given centres) need no
join. A small set (checked: ``|set| * width <= LITERAL_CELLS``) is collected and shipped
with an Arrow-batched NumPy function over the point batches (``mapInArrow``); unrolled
literal expressions overflow the generated-method limit (3.1 s against 0.4 s for 5 points of
width 64 on 400k points, local[8]). A larger set stays a DataFrame and meets the points in
``pairs.cross_blocks`` (blocks of both sides, reduced exactly), so there is no size cap.
Both ways reject points of another width and skip NaN distances alike.

``exact_diameter`` / ``farthest_pair`` are exact, and compare all pairs only of what they cannot rule out:
convex hulls for 2-d points, a ball tree for many wide points, pivots (``farthest_pair_candidates``) else.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dispersa.functions.distance import point_stats
from dispersa.functions.sampling import portable_order
from dispersa.operators import balls, hull, pairs
from dispersa.operators.kcenter import farthest_first

LITERAL_CELLS = 1 << 20   # at most this many coordinates of a point set are shipped to tasks
KERNEL_CELLS = 1 << 20    # distances that a task holds at once


SAMPLE_OVERDRAW = 4   # the hash-prefix filter expects this many times k survivors


def _sample_candidates(points: DataFrame, k: int, seed: int, n: int | None):
    """Yield ``(frame, complete)``: the first ``k`` rows by ``md5('<seed>:<id>')`` among a
    hash-prefix slice expected to hold ``SAMPLE_OVERDRAW * k`` points, widening the slice
    until it is known to contain the true first ``k`` (``complete``)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    key = portable_order("id", seed)
    n = points.count() if n is None else n
    frac = SAMPLE_OVERDRAW * k / max(n, 1)
    while True:
        cand = points
        if frac < 1.0:
            prefix = format(max(1, int(frac * 16 ** 8)), "08x")
            cand = points.where(F.substring(key, 1, 8) < F.lit(prefix))
        yield cand.orderBy(key, F.col("id")).limit(int(k)).select("id", "p"), frac >= 1.0
        frac *= 2.0


def sample_frame(points: DataFrame, k: int, seed: int, n: int | None = None) -> DataFrame:
    """The ``k`` points with the smallest ``md5('<seed>:<id>')`` (reproducible in any SQL
    engine), as a persisted DataFrame ``(id, p)``; the caller unpersists it.

    A plain ``orderBy().limit(k)`` would bring ``k`` rows from every partition together.
    Since md5 keys are uniform, a narrow filter first keeps the keys below a hex prefix
    expected to hold ``SAMPLE_OVERDRAW * k`` points; if at least ``k`` survive, the true
    first ``k`` are among them (smaller prefix means smaller key), else the range doubles.
    About ``4k`` rows then meet in one place, whatever the partition count.
    """
    for sample, last in _sample_candidates(points, k, seed, n):
        sample = sample.persist()
        if last or sample.count() == k:
            return sample
        sample.unpersist()


def sample_points(points: DataFrame, k: int, seed: int, n: int | None = None) -> list[tuple[int, list[float]]]:
    """The same sample brought to the driver in key order (for small samples)."""
    for sample, last in _sample_candidates(points, k, seed, n):
        rows = sample.collect()
        if last or len(rows) == k:
            return [(int(r["id"]), list(r["p"])) for r in rows]


def _check_inline(points_list, what: str) -> int:
    cells = sum(len(p) for _, p in points_list)
    if cells > LITERAL_CELLS:
        raise ValueError(
            f"{what}: {len(points_list)} points x width is {cells} coordinates, above the "
            f"{LITERAL_CELLS} that may be inlined; use a smaller set"
        )
    widths = {len(p) for _, p in points_list}
    if len(widths) > 1:
        raise ValueError(f"{what}: mixed widths {sorted(widths)}")
    return widths.pop() if widths else 0


def _set_kernel(centres, mode: str, radii=None, bound: float = 0.0):
    """Arrow batch function over ``(id, p)`` batches against the fixed set ``centres``."""
    ids = np.array([c for c, _ in centres], dtype=np.int64)
    radii = None if radii is None else np.asarray(radii, dtype=np.float64)
    C = np.array([q for _, q in centres], dtype=np.float64).reshape(len(centres), -1)

    def sq_all(batch):
        X = _batch_matrix(batch.column(1), C.shape[1])
        out = np.zeros((len(C), batch.num_rows))
        for t in range(C.shape[1]):
            diff = X[:, t][None, :] - C[:, t][:, None]
            out += diff * diff
        return out  # |set| x rows

    def run(batches):
        rows = max(1, KERNEL_CELLS // max(1, len(C)))
        for b in (whole.slice(lo, rows) for whole in batches for lo in range(0, whole.num_rows, rows)):
            d = sq_all(b)
            nan = np.isnan(d)
            if mode == "max":
                d[nan] = -np.inf
                m = d.max()
                if m > -np.inf:
                    yield pa.RecordBatch.from_pydict({"sqd": [float(m)]})
            elif mode == "colmax":
                d[nan] = -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(d.max(axis=1))], names=["i", "sqd"])
            elif mode == "keep":
                # Keep a point if some pair through it could still reach the bound.
                ub = (np.sqrt(d) + radii[:, None]).min(axis=0)
                keep = ~(ub < bound)  # NaN rows are kept and left to the exact pass
                if keep.any():
                    yield b.filter(pa.array(keep))
            elif mode == "min":
                d[nan] = np.inf
                m = d.min(axis=0)
                m[np.isinf(m) & np.all(nan, axis=0)] = np.nan
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m)], names=["id", "sqd"])
            else:
                j = np.tile(b.column(0).to_numpy(), len(C))
                i = np.repeat(ids, b.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i), pa.array(j), pa.array(d.reshape(-1))], names=["i", "j", "sqd"]
                )

    return run


def _batch_matrix(col, dim: int) -> np.ndarray:
    lengths = pc.list_value_length(col)
    if len(col) and (pc.min(lengths).as_py() != dim or pc.max(lengths).as_py() != dim or col.null_count):
        raise ValueError(f"point widths differ from the set's width {dim} (or a point is NULL)")
    flat = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(-1, dim)


_SET_SCHEMAS = {"max": "sqd double", "min": "id bigint, sqd double", "all": "i bigint, j bigint, sqd double",
                "colmax": "i bigint, sqd double", "keep": "id bigint, p array<double>"}


def _against_set(points: DataFrame, centres, mode: str, radii=None, bound: float = 0.0) -> DataFrame:
    return points.select("id", "p").mapInArrow(_set_kernel(centres, mode, radii, bound), _SET_SCHEMAS[mode])


def _large_set(points: DataFrame, centres) -> DataFrame | None:
    """The centre set as a DataFrame when it must go through ``pairs.cross_blocks`` (given
    as a DataFrame, or a list above LITERAL_CELLS coordinates); None for the direct paths."""
    if isinstance(centres, DataFrame):
        return centres.select(F.col("id").cast("bigint").alias("id"), F.col("p").cast("array<double>").alias("p"))
    if sum(len(q) for _, q in centres) > LITERAL_CELLS:
        return points.sparkSession.createDataFrame(
            [(int(i), [float(v) for v in q]) for i, q in centres], "id bigint, p array<double>")
    return None


def _cross(points: DataFrame, others: DataFrame, mode: str) -> DataFrame:
    pst = point_stats(points)
    ost = point_stats(others)
    if pst["n"] and ost["n"] and pst["dim"] != ost["dim"]:
        raise ValueError(f"point width {pst['dim']} differs from the set's width {ost['dim']}")
    return pairs.cross_blocks(points.select("id", "p"), others, mode, pst["n"], ost["n"], pst["dim"] or ost["dim"])


def distances_to_set(points: DataFrame, centres) -> DataFrame:
    """``(i, j, sqdist, dist)`` for every centre ``i`` and every point ``j``: ``|set| * n`` rows.

    ``centres``: a list of ``(id, p)`` or a DataFrame ``(id, p)`` of any size."""
    big = _large_set(points, centres)
    if big is not None:
        d = _cross(points, big, "all")
    else:
        _check_inline(centres, "distances_to_set")
        d = _against_set(points, centres, "all")
    return d.select("i", "j", F.col("sqd").alias("sqdist"), F.sqrt("sqd").alias("dist"))


def min_distance_to_set(points: DataFrame, centres) -> DataFrame:
    """``(id, min_dist)``: each point's distance to its nearest centre (NaN distances skipped).

    ``centres``: a list of ``(id, p)`` or a DataFrame ``(id, p)`` of any size."""
    big = _large_set(points, centres)
    if big is not None:
        d = _cross(points, big, "min").groupBy("id").agg(F.min("sqd").alias("sqd"))
    else:
        _check_inline(centres, "min_distance_to_set")
        d = _against_set(points, centres, "min")
    # A point without any distance that is a number has no nearest centre.
    return d.select("id", F.sqrt(F.nanvl("sqd", F.lit(None).cast("double"))).alias("min_dist"))


def sampled_diameter(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``(max_dist)``: max distance between a sample point and any point (0 if empty).

    Samples up to LITERAL_CELLS coordinates are shipped to the tasks; larger ones stay a
    DataFrame and meet the points in ``pairs.cross_blocks``."""
    if k < 1:
        raise ValueError("k must be >= 1")
    head = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("p")).alias("w")).first()
    n, width = int(head["n"]), int(head["w"] or 0)
    if min(k, n) * max(width, 1) > LITERAL_CELLS:
        sample = sample_frame(points, k, seed, n)
        try:
            best = _cross(points, sample, "max").agg(F.max("sqd").alias("sqd"))
            return _one_row(best.select(F.coalesce(F.sqrt("sqd"), F.lit(0.0)).alias("max_dist")))
        finally:
            sample.unpersist()
    sample = sample_points(points, k, seed, n)
    if not sample:
        return points.sparkSession.range(1).select(F.lit(0.0).alias("max_dist"))
    _check_inline(sample, "sampled_diameter")
    best = _against_set(points, sample, "max").agg(F.max("sqd").alias("sqd"))
    return best.select(F.coalesce(F.sqrt("sqd"), F.lit(0.0)).alias("max_dist"))


def sample_with_replacement(points: DataFrame, k: int, seed: int) -> DataFrame:
    """``(draw, id, p)``: ``k`` independent draws (numbered from 0), a point may be drawn again; none from an
    empty set.

    Two passes. The first counts the points in 4,096 buckets of their id's MD5; the draws (MD5 of seed and number,
    modulo the count) split over the buckets by their prefix sums, as a multinomial split would. The second
    numbers the points of the drawn buckets by id and joins the draws. The rows' placement plays no part, so a
    retried task and any other engine draw the same points; ids should be distinct. ``k`` is bounded by what the
    driver holds (LITERAL_CELLS).
    """
    if not 1 <= k <= LITERAL_CELLS:
        raise ValueError(f"k must be between 1 and {LITERAL_CELLS}")
    bucketed = points.select("id", "p", F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 3), 16, 10).cast("int").alias("bucket"))
    counts = {r["bucket"]: r["n"] for r in bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = sorted(counts)
    ends = np.cumsum([counts[b] for b in buckets], dtype=np.int64)
    rows = []
    for draw in range(k if buckets else 0):
        at = int(hashlib.md5(f"{int(seed)}:{draw}".encode()).hexdigest()[:15], 16) % int(ends[-1])
        b = int(np.searchsorted(ends, at, "right"))
        rows.append((draw, buckets[b], at - int(ends[b]) + counts[buckets[b]] + 1))
    draws = points.sparkSession.createDataFrame(rows, "draw int, bucket int, place bigint")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("id")).cast("bigint")
    asked = bucketed.join(F.broadcast(draws.select("bucket").distinct()), "bucket", "left_semi").withColumn("place", place)
    return asked.join(F.broadcast(draws), ["bucket", "place"]).select("draw", "id", "p")


def replaced_sample_diameter(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``(max_dist)`` like ``sampled_diameter`` (0 if empty), with the sample drawn with replacement as the
    reference draws it: repeated draws leave fewer distinct points, so the bound holds for those."""
    drawn = sample_with_replacement(points, k, seed).select("id", "p").distinct().collect()
    if not drawn:
        return points.sparkSession.range(1).select(F.lit(0.0).alias("max_dist"))
    sample = [(int(r["id"]), list(r["p"])) for r in drawn]
    big = _large_set(points, sample)
    best = _cross(points, big, "max") if big is not None else _against_set(points, sample, "max")
    return best.agg(F.coalesce(F.sqrt(F.max("sqd")), F.lit(0.0)).alias("max_dist"))


def _one_row(df: DataFrame) -> DataFrame:
    """Compute a one-row result now (its inputs are about to be released) as a local table."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


PIVOTS = 16          # pivot points used to prune farthest-pair candidates
PRUNE_SLACK = 1e-9   # relative slack on the pruning bound (rounding of the two sides)
SURVIVOR_SHARE = 0.5  # skip the filter pass when more than this share is expected to survive


def farthest_pair_candidates(points: DataFrame, pivots: int = PIVOTS, seed: int = 0,
                             n: int | None = None) -> tuple[DataFrame, float, bool]:
    """The points that can still be an end of the farthest pair, a lower bound on D, and
    whether a filter was applied.

    One pass gives every pivot ``c`` its radius ``R_c = max_q d(q, c)``; ``LB = max R_c``
    is a lower bound on the diameter. If ``(a, b)`` is a farthest pair, then for every
    pivot ``D = d(a, b) <= d(a, c) + R_c``, so ``a`` (and ``b``) satisfy
    ``min_c (d(p, c) + R_c) >= D >= LB``; every other point is dropped. Exact, ties
    included. A second pass applies the filter; nothing is gathered anywhere.
    """
    piv = sample_points(points, pivots, seed, n=n)
    if len(piv) < 2:
        return points, 0.0, False
    _check_inline(piv, "farthest_pair_candidates")
    rows = _against_set(points, piv, "colmax").groupBy("i").agg(F.max("sqd").alias("sqd")).collect()
    radius = {r["i"]: math.sqrt(r["sqd"]) if r["sqd"] >= 0 else math.inf for r in rows}  # -inf: all distances NaN
    radii = [radius[c] for c, _ in piv]
    lb = max(r for r in radii if r < math.inf) if min(radii) < math.inf else math.inf
    if not math.isfinite(lb) or not np.isfinite([q for _, q in piv]).all():
        return points, 0.0, False  # infinite distances: nothing to prune with
    bound = lb * (1.0 - PRUNE_SLACK)
    # The pivots are a random sample: the share of them that would survive (each judged
    # by the other pivots) estimates the share of all points that would. If most would,
    # the filter pass is not worth running (e.g. high-dimensional, evenly spread points).
    P = np.array([q for _, q in piv])
    D = np.sqrt(((P[:, None, :] - P[None, :, :]) ** 2).sum(axis=2)) + np.array(radii)[None, :]
    np.fill_diagonal(D, np.inf)
    if np.mean(~(D.min(axis=1) < bound)) > SURVIVOR_SHARE:
        return points, lb, False
    return _against_set(points, piv, "keep", radii, bound), lb, True


def _pruned(points: DataFrame, stats: dict) -> tuple[DataFrame, dict | None]:
    """Candidates for the farthest pair, and their stats when already known."""
    kept, _, filtered = farthest_pair_candidates(points, n=stats["n"])
    return kept, (None if filtered else stats)


def _flat(points: DataFrame) -> bool:
    """Whether the first point is 2-d (the hull's own tasks reject sets of other or mixed widths)."""
    row = points.select(F.size("p").alias("w")).first()
    return row is not None and row["w"] == 2


def _best_pairs(points: DataFrame) -> DataFrame:
    """``(sqd, i, j)``: the farthest pair among a few rows (none without a pair). Many wide finite points go
    through a ball tree (``operators.balls``); else, or where that gives up: pivot pruning and hashed block
    pairs."""
    stats = point_stats(points)
    if stats["n"] < 2:
        return pairs.block_pairs(points, "best", stats=stats)
    if not stats["nans"] and stats["n"] > pairs.block_rows(stats["dim"]):
        searched = ball_search(points, stats)
        if searched.best is not None:
            return searched.best
    kept, kept_stats = _pruned(points, stats)
    return pairs.block_pairs(kept, "best", stats=kept_stats)


def ball_search(points: DataFrame, stats: dict | None = None) -> balls.Search:
    """The ball-tree search of the farthest pair: its block pairs' results, how many pairs of balls it opened,
    and the reason if it gave up."""
    stats = stats or point_stats(points)
    sample = sample_points(points, balls.sample_size(stats["n"], stats["dim"]), seed=0, n=stats["n"])
    return balls.search(points, sample, stats["n"], stats["dim"])


def farthest_pair(points: DataFrame, prune: bool = True) -> DataFrame:
    """``(i, j, sqdist, dist)``: the farthest pair, ``i < j``, ties to the smallest ``(i, j)``. No row when fewer
    than two points (or only NaN distances) exist. 2-d points: by convex hulls (``operators.hull``), now, unless
    the hull is too large. ``prune=False`` compares all pairs."""
    if not prune:
        return pairs.farthest_pair(points)
    found = hull.farthest_pair(points) if _flat(points) else False
    if found is False:
        return pairs.best_of(_best_pairs(points))
    rows = [] if found is None else [(found[1], found[2], found[0], math.sqrt(found[0]))]
    return points.sparkSession.createDataFrame(rows, "i bigint, j bigint, sqdist double, dist double")


def exact_diameter(points: DataFrame, prune: bool = True) -> DataFrame:
    """``(max_dist)`` over all pairs; 0 for fewer than two points. By the same ways as ``farthest_pair``."""
    if not prune:
        return pairs.exact_diameter(points)
    found = hull.farthest_pair(points) if _flat(points) else False
    if found is False:
        return _best_pairs(points).agg(F.coalesce(F.sqrt(F.max("sqd")), F.lit(0.0)).alias("max_dist"))
    return points.sparkSession.createDataFrame([(0.0 if found is None else math.sqrt(found[0]),)], "max_dist double")


def k_center_diameter(points: DataFrame, k: int, first: str | int = "min_id") -> DataFrame:
    """``(max_dist)``: exact diameter of the ``k`` farthest-first centres (a lower bound on D)."""
    centres = farthest_first(points, k, first=first).select("id", "p")
    return pairs.exact_diameter(centres)


def point_set_summary(points: DataFrame, k: int, L: int) -> DataFrame:
    """``(n_points, dim, k, l)``: the loader's report (count, width and the run's parameters). Points of
    different widths are an error in the result's job, as in every point operator."""
    widths = F.when(F.min(F.size("p")) != F.max(F.size("p")), F.raise_error(F.lit("point set mixes widths")).cast("int"))
    return points.agg(
        F.count(F.lit(1)).alias("n_points"), F.coalesce(widths, F.max(F.size("p"))).alias("dim")
    ).select("n_points", "dim", F.lit(int(k)).alias("k"), F.lit(int(L)).alias("l"))
