"""Embedding whitening by a bit-sliced scatter.

Every coordinate becomes an integer code ``floor(scale * c) + offset``. The fit list is each distinct code
vector once. The scatter matrix of the fit list is exact: a task takes its codes less their minimum in each
dimension, packs every bit plane of a dimension across the rows into 64-bit words, and the weighted popcounts
of the ANDs of two dimensions' planes are their cross-product. The shifts are undone in integers, Spark adds
the tasks' sums, the driver centres ``n * C - S * S'`` in integers (width squared numbers) and ``eigh`` gives
the components.

Passes: one shuffle for the distinct code vectors, two passes over them (scatter; covariance of the whitened
vectors), one pass over all rows. No task holds more than ``BLOCK`` rows at a time, and a vector that a third
of all rows share is combined before the shuffle.

Defined results: rows whose vector is NULL, has no entries, or holds a NULL or non-finite entry are dropped.
Repeated rows and ids are kept, each with its own result; NULL ids too. Vectors of different widths, or a
code beyond ``CODE_LIMIT``, are an error. A component without variance (fewer distinct vectors than
dimensions, a constant dimension) has ``whitened`` NULL; ``explained`` is NULL if no dimension varies, and
``identity_error`` covers the components with variance (NULL if there are none). An empty table gives no
rows. Other columns of the table are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispersa.functions.distance import has_bad_coordinate
from dispersa.llm.shared import written

BLOCK = 8192            # rows whose bit planes a task holds at once
CODE_LIMIT = 1 << 40    # codes keep below this, so that sums of their products fit 38 digits
WIDE = 1 << 62          # int64 arithmetic is used where a bound proves that it suffices


class Fit(NamedTuple):
    """What the rows are whitened with: plain numbers and arrays, bounded by the width of the vectors."""

    n: int
    sums: list[int]         # of the codes without the offset
    vectors: np.ndarray     # width x components
    scales: np.ndarray      # 1 / sqrt(eigenvalue), 0 without variance
    explained: list[float]


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    widths = set(np.diff(column.offsets.to_numpy()).tolist())
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths: {sorted(widths)[:5]}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _codes(values: np.ndarray, scale: int) -> np.ndarray:
    raised = np.floor(values * float(scale))
    if len(raised) and np.abs(raised).max(initial=0) >= CODE_LIMIT:
        raise ValueError("an entry is beyond the range of the integer codes")
    return raised.astype(np.int64)


def bit_sliced(codes: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sums and cross-products (object integers, upper triangle) of the columns of ``codes``."""
    rows, width = codes.shape
    low = codes.min(axis=0)
    shifted = (codes - low).astype(np.uint64)
    bits = [max(1, int(top).bit_length()) for top in shifted.max(axis=0)]
    first = np.concatenate([[0], np.cumsum(bits)])[:-1]
    place = np.concatenate([np.arange(b) for b in bits])
    planes = np.zeros((sum(bits), -(-rows // 64) * 8), np.uint8)
    for d in range(width):
        on = (shifted[:, d][None, :] >> np.arange(bits[d], dtype=np.uint64)[:, None]) & np.uint64(1)
        packed = np.packbits(on.astype(np.uint8), axis=1, bitorder="little")
        planes[first[d]: first[d] + bits[d], : packed.shape[1]] = packed
    planes = planes.view(np.uint64)
    narrow = 2 * max(bits) + rows.bit_length() + 1 < 62
    weight = np.int64(1) << place.astype(np.int64) if narrow else np.array([1 << int(p) for p in place], object)
    count = lambda words: np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    total = np.add.reduceat(count(planes) * weight, first).astype(object)
    cross = np.zeros((width, width), object)
    for d in range(width):
        rest = planes[first[d]:]
        found = sum((count(rest & planes[first[d] + p]) * weight[first[d]:]) * (1 << p) for p in range(bits[d]))
        cross[d, d:] = np.add.reduceat(found, first[d:] - first[d]).astype(object)
    # Undo the shifts: sum (x + a)(y + b) = sum xy + b sum x + a sum y + n a b.
    a = low.astype(object)
    cross = np.triu(cross + np.outer(total, a) + np.outer(a, total) + rows * np.outer(a, a))
    return [int(t + rows * s) for t, s in zip(total, a)], cross


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each number of the task's part of the fit list: its size, sums and cross-products."""
    n, sums, cross = 0, None, None
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            codes = _matrix(batch.column(0).slice(lo, BLOCK))
            s, c = bit_sliced(codes)
            if sums is not None and len(s) != len(sums):
                raise ValueError(f"vectors of different widths: {len(s)}, {len(sums)}")
            n, sums, cross = n + len(codes), s if sums is None else [x + y for x, y in zip(sums, s)], c if cross is None else cross + c
    if n:
        width = len(sums)
        numbers = [n, *sums, *cross[np.triu_indices(width)].tolist()]
        yield pa.RecordBatch.from_pydict({
            "width": pa.array([width] * len(numbers), pa.int32()), "place": pa.array(range(len(numbers)), pa.int32()),
            "number": pa.array([Decimal(int(x)) for x in numbers], pa.decimal128(38, 0))})


def _spread(fit: Fit):
    """Batch -> (whitened rows x components, deviations as integers)."""
    middle = [s // fit.n for s in fit.sums]
    rest = [s - fit.n * m for s, m in zip(fit.sums, middle)]
    part = np.array([r / fit.n for r in rest])
    whole = np.array(middle, np.int64)
    weights = fit.vectors * fit.scales

    def whitened(codes: np.ndarray) -> np.ndarray:
        return ((codes - whole) - part) @ weights

    def deviation(codes: np.ndarray) -> list[int]:
        off = codes - whole
        if len(off) and len(rest) * (fit.n * (int(np.abs(off).max()) + 1)) ** 2 < WIDE:
            d = off * fit.n - np.array(rest, np.int64)
            return (d * d).sum(axis=1).tolist()
        return [sum((int(v) * fit.n - r) ** 2 for v, r in zip(row, rest)) for row in off]

    return whitened, deviation


def _covariance(fit: Fit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whitened, _ = _spread(fit)
        k = len(fit.scales)
        total = np.zeros((k + 1, k))
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                w = whitened(_matrix(batch.column(0).slice(lo, BLOCK)))
                total += np.vstack([w.sum(axis=0), w.T @ w])
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(total.size), pa.int32()), "number": total.ravel()})

    return run


def _apply(fit: Fit, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whitened, deviation = _spread(fit)
        k = len(fit.scales)
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                b = batch.slice(lo, BLOCK)
                codes = _codes(_matrix(b.column(1)), scale)
                if codes.shape[1] != len(fit.sums):
                    raise ValueError(f"vectors of different widths: {codes.shape[1]}, {len(fit.sums)}")
                flat = pa.array(whitened(codes).ravel())
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array([Decimal(x) for x in deviation(codes)], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * k), flat)],
                    names=["_id", "deviation", "parts"])

    return run


def vectors_of(rows: DataFrame, vector: str, row_id: str) -> DataFrame:
    """``(_id, _v)`` of the rows that have a usable vector."""
    kept = rows.select(F.col(row_id).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    return kept.where(F.col("_v").isNotNull() & (F.size("_v") > 0) & ~has_bad_coordinate("_v"))


def fit_list(vectors: DataFrame, scale: int) -> DataFrame:
    """``(codes)``: each distinct code vector once (without the offset, which moves no covariance)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = _codes(_matrix(b.column(0)), scale) if b.num_rows else np.zeros((0, 1), np.int64)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * codes.shape[1])
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))], names=["codes"])

    return vectors.select("_v").mapInArrow(run, "codes array<bigint>").distinct()


def fit(codes: DataFrame, components: int) -> Fit | None:
    """Components of the fit list; None if it is empty."""
    added = codes.mapInArrow(_scatter, "width int, place int, number decimal(38,0)").groupBy("width", "place").agg(
        F.sum("number").alias("number")).collect()
    if not added:
        return None
    widths = {r["width"] for r in added}
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths: {sorted(widths)[:5]}")
    width = widths.pop()
    numbers = [int(r["number"]) for r in sorted(added, key=lambda r: r["place"])]
    n, sums = numbers[0], numbers[1: width + 1]
    cov = np.zeros((width, width))
    for (i, j), c in zip(zip(*np.triu_indices(width)), numbers[width + 1:]):
        cov[i, j] = cov[j, i] = (n * c - sums[i] * sums[j]) / (n * n)  # integers: one rounding
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[: min(components, width)]
    values, vectors = values[order], vectors[:, order]
    trace = float(np.trace(cov))
    some = values > max(float(values[0]), 0.0) * width * np.finfo(float).eps
    scales = np.where(some, 1.0 / np.sqrt(np.where(some, values, 1.0)), 0.0)
    return Fit(n, sums, vectors, scales, [max(0.0, float(v)) / trace if trace > 0 else None for v in values])


def identity_error(codes: DataFrame, fitted: Fit) -> float | None:
    """Largest entry of the whitened fit list's covariance less the identity, measured on the vectors."""
    k = len(fitted.scales)
    some = np.flatnonzero(fitted.scales)
    if not len(some):
        return None
    added = codes.mapInArrow(_covariance(fitted), "place int, number double").groupBy("place").agg(
        F.sum("number").alias("number")).collect()
    total = np.zeros((k + 1) * k)
    for r in added:
        total[r["place"]] = r["number"]
    total = total.reshape(k + 1, k) / fitted.n
    cov = total[1:] - np.outer(total[0], total[0])
    return float(np.abs(cov - np.eye(k))[np.ix_(some, some)].max())


OUT = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id", components: int = 16, scale: int = 64,
           offset: int = 1_000_000) -> DataFrame:
    """``(row_id, component, n, deviation, whitened, explained, identity_error)`` for each row with a usable
    vector and each component, numbered from 1 by falling eigenvalue.

    ``n`` vectors in the fit list; ``deviation`` = sum over dimensions of ``(n*x - S)^2``, exact (``offset``
    drops out of it); ``whitened`` = ``x - S/n`` on the component over the root of its eigenvalue;
    ``explained`` = eigenvalue over the trace; ``identity_error`` as measured on the fit list.
    """
    vectors = vectors_of(rows, vector, row_id)
    codes = written(fit_list(vectors, scale), "codes")
    fitted = fit(codes, components)
    kind = vectors.schema["_id"].dataType.simpleString()
    if fitted is None:
        return rows.sparkSession.createDataFrame([], f"`{row_id}` {kind}, {OUT}")
    error = identity_error(codes, fitted)
    parts = vectors.mapInArrow(_apply(fitted, scale), f"_id {kind}, deviation decimal(38,0), parts array<double>")
    flat = parts.select("_id", "deviation", F.posexplode("parts").alias("at", "value"))
    numbers = lambda values: F.array(*[F.lit(v).cast("double") for v in values])
    some = F.array(*[F.lit(bool(s)) for s in fitted.scales])
    at = F.col("at") + 1
    return flat.select(
        F.col("_id").alias(row_id), at.alias("component"), F.lit(fitted.n).cast("bigint").alias("n"), "deviation",
        F.when(F.element_at(some, at), F.col("value")).alias("whitened"),
        F.element_at(numbers(fitted.explained), at).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
