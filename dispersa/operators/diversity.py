"""Diversity maximization: greedy max-distance matching on a farthest-first core-set.

``greedy_matching(points, k)`` takes ``k//2`` times the farthest pair of points not yet
taken, then (odd ``k``) the smallest remaining id: the reference's sequential
2-approximation for remote-clique. One Spark action finds all pairs:

* Partner lists: for every point its ``k-1`` farthest partners. In round ``r`` at most
  ``k-2`` points are taken, and if ``(a, b)`` is the farthest remaining pair (ties: smallest
  ``(a, b)``), then ``b`` is ``a``'s best partner among the points not taken — any better or
  equally far, smaller partner ``c`` would make ``(a, c)`` win — so ``b`` is within ``a``'s
  first ``(taken + 1) <= k-1`` partners, and ``a`` within ``b``'s: the pair is mutual.
* A point is in at most ``k-1`` mutual pairs, so a pick takes itself and at most ``2(k-2)``
  others out of play, and the ``r``-th pick is among the first ``(r-1)(2k-3) + 1`` mutual
  pairs: at most ``k*k`` pairs, an ordered limit, decide all rounds.

Partner lists are capped at ``PARTNERS_MAX`` and rebuilt over the remaining points once
that many could have been taken, so large ``k`` never materialises all pairs: one action
up to ``k = PARTNERS_MAX + 1``, then one for every ``PARTNERS_MAX / 2`` rounds.

``diversity_maximization(points, k, L)``: core-set = ``k`` farthest-first centres per part
(``L`` parts), all parts advancing together, then greedy matching on the ``L*k``
core-set points. ``diversity_score`` is the average pairwise distance of an answer.

Divergence from the reference: when all remaining points coincide it adds the first
point twice; here the smallest remaining pair at distance 0 is taken instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispersa.functions.distance import point_stats, require_finite
from dispersa.operators import candidates, pairs
from dispersa.operators.kcenter import farthest_first

PARTITIONINGS = ("hash", "modulo")


def _rounds_frame(points: DataFrame, picks: dict[int, int]) -> DataFrame:
    """``(round, id, p)`` of the picked ids, derived from the point table itself."""
    rounds = points.sparkSession.createDataFrame(list(picks.items()), "id bigint, round int")
    return points.join(rounds, "id").select("round", "id", "p")


PARTNERS_MAX = 1024   # partner-list length; lists are rebuilt when more points are taken


def _without(points: DataFrame, taken: list[int]) -> DataFrame:
    if not taken:
        return points
    if len(taken) <= 1024:
        return points.where(~F.col("id").isin(taken))
    ids = points.sparkSession.createDataFrame([(t,) for t in taken], "id bigint")
    return points.join(ids, "id", "left_anti")


def _first_pairs(points: DataFrame, M: int, rounds: int, stats: dict) -> DataFrame:
    """``(i, j, sqd)``: the first mutual pairs of partner lists of length ``M``, enough for ``rounds`` picks."""
    mutual = pairs.top_partners(points, M, stats=stats).groupBy(
        F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).agg(
        F.max("sqd").alias("sqd"), F.count(F.lit(1)).alias("sides")).where("sides = 2")
    return mutual.select("i", "j", "sqd").orderBy(F.col("sqd").desc(), "i", "j").limit((rounds - 1) * (2 * M - 1) + 1)


def greedy_matching(points: DataFrame, k: int, stats: dict | None = None) -> DataFrame:
    """``(round, id, p)``: pairs get rounds ``1..k//2``, the odd point round ``k//2 + 1``.

    If ``k >= n`` every point is returned with round 0 (as the reference returns all).
    Partner lists hold ``M = min(k-1, PARTNERS_MAX)`` entries and stay exact while fewer
    than ``M`` points have been taken since they were built (see the module docstring).
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    stats = stats or point_stats(points)
    require_finite(stats, "greedy_matching")
    n = stats["n"]
    if k >= n:
        return points.select(F.lit(0).alias("round"), "id", "p")
    picks: dict[int, int] = {}
    rounds, r = k // 2, 1
    M = min(k - 1, PARTNERS_MAX)
    while r <= rounds or len(picks) < k:
        now = min((M + 1) // 2, rounds - r + 1)
        rest = _without(points, list(picks))
        asked = []
        if now:
            asked.append(_first_pairs(rest, M, now, {**stats, "n": n - len(picks)}))
        if k % 2 and r + now > rounds:  # the odd point: the smallest id that the picks of this action leave
            asked.append(rest.select(F.col("id").alias("i"), F.lit(None).cast("bigint").alias("j"),
                                     F.lit(None).cast("double").alias("sqd")).orderBy("i").limit(2 * now + 1))
        rows = reduce(DataFrame.unionByName, asked).collect()
        for row in sorted((x for x in rows if x["j"] is not None), key=lambda x: (-x["sqd"], x["i"], x["j"])):
            if r <= rounds and now and row["i"] not in picks and row["j"] not in picks:
                picks[row["i"]] = picks[row["j"]] = r
                r, now = r + 1, now - 1
        left = [x["i"] for x in rows if x["j"] is None and x["i"] not in picks]
        if left:
            picks[min(left)] = rounds + 1
    return _rounds_frame(points, picks)


def part_of(id_col: str, L: int) -> Column:
    """Part of an id: its MD5 (any SQL engine has it) modulo ``L``, so ids of any pattern spread evenly."""
    return F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(int(L))


def core_set(points: DataFrame, k: int, L: int, partitioning: str = "hash",
             first: str | int = "min_id") -> DataFrame:
    """``(part, ord, id, p, min_dist)``: ``k`` farthest-first centres from each of ``L`` parts.

    ``hash``: part = md5(id) modulo ``L``, at most ``L`` parts of like size for any ids; ``modulo``:
    part = ``pmod(id, L)``, which follows the ids' pattern. A part with fewer than ``k`` points gives
    all of them.
    """
    if L < 1:
        raise ValueError("L must be >= 1")
    if partitioning == "hash":
        part = part_of("id", L)
    elif partitioning == "modulo":
        part = F.pmod(F.col("id"), F.lit(int(L)))
    else:
        raise ValueError(f"unknown partitioning {partitioning!r}; use one of {PARTITIONINGS}")
    return farthest_first(points.withColumn("part", part), k, by="part", first=first, short_groups=True)


def core_set_merged(points: DataFrame, k: int, L: int, chunks: int) -> DataFrame:
    """``(part, ord, id, p, min_dist)``: a core-set of the parts of ``core_set`` in one job whatever ``k``.

    Each part is cut into ``chunks`` chunks by a second piece of the id's MD5; a chunk's ``k`` farthest-first
    centres are its summary, and the traversal of a part's summaries gives the part's ``k`` centres. The
    covering radius of a part is at most 4 times that of ``core_set`` (see ``candidates.merged_traversal``).
    ``candidates.chunk_count`` gives a number of chunks for a set's size. Points of mixed widths, or with NULL,
    NaN or infinite coordinates, are an error in the result's job; an empty set gives no rows.
    """
    if k < 1 or L < 1 or chunks < 1:
        raise ValueError("k, L and chunks must be >= 1")
    second = F.conv(F.substring(F.md5(F.col("id").cast("string")), 9, 8), 16, 10).cast("bigint") % F.lit(int(chunks))
    return candidates.merged_traversal(points.select(part_of("id", L).alias("part"), "id", "p"), k, second)


def diversity_maximization(points: DataFrame, k: int, L: int, partitioning: str = "hash",
                           first: str | int = "min_id") -> DataFrame:
    """``(round, id, p)``: the ``k`` points of the two-round MapReduce answer."""
    core = core_set(points, k, L, partitioning, first).select("id", "p")
    return greedy_matching(core, k)


def diversity_score(answer: DataFrame) -> DataFrame:
    """``(avg_dist)``: average distance over unordered pairs of the answer."""
    return pairs.average_pairwise_distance(answer.select("id", "p"))
