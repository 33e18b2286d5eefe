"""Euclidean distance expressions over ``array<double>`` points.

Spark has no vector distance function, so distances are written as plain arithmetic.
For a known width up to ``UNROLL_MAX`` the squared distance is unrolled into
``(p[0]-q[0])*(p[0]-q[0]) + ...`` which whole-stage codegen compiles into a tight
loop; wider points use the ``aggregate(zip_with(...))`` higher-order form. Terms
are summed left to right, the same order as a sequential loop.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

UNROLL_MAX = 128


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sqdist(p: Column | str, q: Column | str | Sequence[float], dim: int | None = None) -> Column:
    """Squared Euclidean distance between point column ``p`` and a column or literal point ``q``.

    With column names and a known width the expression is built from one SQL string
    (one driver call instead of hundreds).
    """
    if isinstance(q, (list, tuple)):
        vals = [float(v) for v in q]
        if dim is not None and dim != len(vals):
            raise ValueError(f"literal point has width {len(vals)}, expected {dim}")
        if isinstance(p, str) and vals and all(math.isfinite(v) for v in vals):
            # Shortest exact repr with the D suffix parses back to the same double.
            return F.expr(" + ".join(f"({p}[{i}] - ({v!r}D)) * ({p}[{i}] - ({v!r}D))" for i, v in enumerate(vals)))
        pc = _c(p)
        terms = [(pc[i] - F.lit(v)) * (pc[i] - F.lit(v)) for i, v in enumerate(vals)]
        return reduce(add, terms) if terms else F.lit(0.0)
    if isinstance(p, str) and isinstance(q, str) and dim is not None and dim <= UNROLL_MAX:
        if dim == 0:
            return F.lit(0.0)
        return F.expr(" + ".join(f"({p}[{i}] - {q}[{i}]) * ({p}[{i}] - {q}[{i}])" for i in range(dim)))
    pc, qc = _c(p), _c(q)
    if dim is not None and dim <= UNROLL_MAX:
        terms = [(pc[i] - qc[i]) * (pc[i] - qc[i]) for i in range(dim)]
        return reduce(add, terms) if terms else F.lit(0.0)
    return F.aggregate(
        F.zip_with(pc, qc, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v
    )


def dist(p: Column | str, q: Column | str | Sequence[float], dim: int | None = None) -> Column:
    """Euclidean distance."""
    return F.sqrt(sqdist(p, q, dim))


def has_bad_coordinate(p: Column | str) -> Column:
    """True if a point holds a NULL, NaN or infinite coordinate (or is NULL). Built-in and codegen'd:
    Spark SQL compares NaN equal to NaN, and a NULL element makes the lookup NULL."""
    found = [F.array_contains(_c(p), F.lit(v)) for v in (math.nan, math.inf, -math.inf)]
    return F.coalesce(reduce(lambda a, b: a | b, found), F.lit(True))


def point_stats(points) -> dict:
    """One pass over the points: count, common width, and points with NULL, NaN or infinite coordinates.

    Raises ``ValueError`` on mixed widths or NULL points.
    """
    row = points.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.size("p")).alias("dmin"),
        F.max(F.size("p")).alias("dmax"),
        F.sum(F.when(F.col("p").isNull(), 1).otherwise(0)).alias("nulls"),
        F.sum(F.when(F.col("p").isNotNull() & has_bad_coordinate("p"), 1).otherwise(0)).alias("nans"),
    ).first()
    n = int(row["n"])
    if n and row["nulls"]:
        raise ValueError("point set holds NULL points")
    if n and row["dmin"] != row["dmax"]:
        raise ValueError(f"point set mixes widths {row['dmin']} and {row['dmax']}")
    return {"n": n, "dim": int(row["dmin"]) if n else 0, "nans": int(row["nans"] or 0)}


def require_finite(stats: dict, what: str) -> None:
    if stats["nans"]:
        raise ValueError(f"{what}: {stats['nans']} point(s) hold NULL, NaN or infinite coordinates")
