"""URL filter: host and path rules first, and for the rest the ratio of two character language models.

The models are smoothed variable-order Markov chains over the bytes of a URL (after its scheme), one for
accepted and one for rejected URLs. The probability of a byte after the longest context is a blend of all
shorter ones: P_o = (n(context, byte) + A * P_(o-1)) / (n(context) + A), so a context that was never seen
leaves the word to the next shorter one. Counts live in a table of ``SLOTS`` hashed cells per model, which
bounds what is collected and sent to tasks whatever the number of URLs; every URL that a rule decides is
counted. The score is the difference of the two log10 likelihoods per byte. The verdict's threshold is
calibrated: URLs that a rule decides are scored by the model of the other half of them, and the
threshold with the best balanced accuracy in a fixed histogram is taken (the one nearest to 0 of ties).

Defined results: a NULL URL or one without ``://`` has an empty host and path, fits no rule and is scored
as the bytes it has; an empty one scores 0. Without accepted or rejected URLs every score is 0 and the
threshold 0, so all other URLs are allowed. Repeated rows are judged (and counted) row by row; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispersa.llm import text as T

ORDER = 4  # longest context in bytes
SLOTS = 1 << 18  # cells of a model
BLEND = 4.0
BINS, REACH = 2001, 5.0  # the calibration's histogram covers scores from -REACH to REACH


class Rule(NamedTuple):
    text: str  # host/path
    verdict: str  # allow or block


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule whose host is the URL's or a parent domain, and whose path starts the URL's."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # a longer one replaces a shorter one
        rule_host, _, rule_path = rule.text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def _grams(part: T.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of every byte: (ORDER + 1, n) cells of context and byte, the same of the context alone, and
    the byte's row."""
    n, rows = len(part.data), T.row_of(part.bounds)
    code = T.mix(part.data.astype(np.uint64) + T.U64(11))
    at = np.arange(n) - part.bounds[rows]  # place in the URL
    gram = np.empty((ORDER + 1, n), np.int64)
    context = np.empty((ORDER + 1, n), np.int64)
    past = np.zeros(n, np.uint64)
    cells = T.U64(SLOTS - 1)
    for o in range(ORDER + 1):
        if o:
            # A byte before the URL's start counts as its own sign.
            earlier = np.zeros(n, np.uint64)
            earlier[o:] = code[: n - o]
            past = T.mix(past * T.U64(31) + np.where(at >= o, earlier, T.U64(1)) + T.U64(o))
        context[o] = (T.mix(past ^ T.U64(0x5BD1E995 + o)) & cells).astype(np.int64)
        gram[o] = (T.mix(past * T.U64(7) + code + T.U64(o)) & cells).astype(np.int64)
    return gram, context, rows


class Models(NamedTuple):
    """Counts of (accepted, rejected) x cells: of context and byte, and of contexts."""

    gram: np.ndarray
    context: np.ndarray

    def scores(self, part: T.Slice) -> np.ndarray:
        """log10 likelihood of accepted over rejected per byte, for each row."""
        gram, context, rows = _grams(part)
        logs = []
        for side in (0, 1):
            p = np.full(len(part.data), 1 / 256)
            for o in range(ORDER + 1):
                p = (self.gram[side][gram[o]] + BLEND * p) / (self.context[side][context[o]] + BLEND)
            logs.append(np.log10(np.minimum(p, 1.0)))
        total = np.bincount(rows, weights=logs[0] - logs[1], minlength=part.rows)
        return total / np.maximum(1, np.diff(part.bounds))


def _slices(batches: Iterator[pa.RecordBatch], at: int):
    for batch in batches:
        for part in T.slices(batch.column(at), 1 << 18):
            yield batch.slice(part.first, part.rows), part


def train(urls: DataFrame) -> list[Models]:
    """Models of each half of the decided URLs (columns text, side 0/1, half 0/1). Each task sends at most
    one number per cell; the sums are 8 x SLOTS numbers whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(8 * SLOTS, np.int64)
        for here, part in _slices(batches, 0):
            gram, context, rows = _grams(part)
            group = (here.column(2).to_numpy() * 2 + here.column(1).to_numpy())[rows] * SLOTS
            for o in range(ORDER + 1):
                total += np.bincount(group + gram[o], minlength=len(total))
                total += np.bincount(group + 4 * SLOTS + context[o], minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(total[cells])], ["cell", "n"])

    sums = urls.select("text", "side", "half").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.zeros(8 * SLOTS)
    found = sums.toPandas()
    total[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    total = total.reshape(2, 2, 2, SLOTS)  # kind, half, side, cell
    return [Models(total[0, h], total[1, h]) for h in (0, 1)]


def calibrate(urls: DataFrame, halves: list[Models]) -> float:
    """The threshold with the best balanced accuracy over the decided URLs, each scored by the model of
    the half that it is not in."""
    shared = urls.sparkSession.sparkContext.broadcast([tuple(m) for m in halves])  # plain arrays: no class to import

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BINS), np.int64)
        for here, part in _slices(batches, 0):
            side, half = here.column(1).to_numpy(), here.column(2).to_numpy()
            score = np.where(half == 0, Models(*shared.value[1]).scores(part), Models(*shared.value[0]).scores(part))
            np.add.at(total, (side, _bin(score)), 1)
        s, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(s * BINS + b, pa.int64()), pa.array(total[s, b])], ["cell", "n"])

    found = (urls.select("text", "side", "half").mapInArrow(run, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())  # 2 x BINS rows at most
    total = np.zeros(2 * BINS)
    total[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    accepted, rejected = total.reshape(2, BINS)
    if not accepted.sum() or not rejected.sum():
        return 0.0
    # Threshold at the lower edge of bin k: accepted from k on, rejected below.
    right = accepted[::-1].cumsum()[::-1] / accepted.sum() + np.concatenate([[0], rejected.cumsum()[:-1]]) / rejected.sum()
    edges = (np.arange(BINS) / (BINS - 1) * 2 - 1) * REACH
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


def _bin(score: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((score / REACH + 1) / 2 * (BINS - 1)), 0, BINS - 1).astype(np.int64)


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score and threshold."""
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"))
    has = F.instr("url", "://") > 0
    rest = F.when(has, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    lowered = F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = (rows.withColumn("rest", rest)
            .withColumn("host", lowered)
            .withColumn("path", F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1))
            .withColumn("text", F.when(has, F.col("rest")).otherwise(F.col("url"))))
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    side = F.lit(None).cast("int")
    for rule in rules:
        side = F.when(F.col("rule") == rule.text, F.lit(0 if rule.verdict == "allow" else 1)).otherwise(side)
    rows = rows.withColumn("side", side)
    # Halves by a hash of the URL, so copies of one URL are in one half.
    decided = rows.filter("side is not null").select("text", "side", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"))
    halves = train(decided)
    threshold = calibrate(decided, halves)
    both = Models(halves[0].gram + halves[1].gram, halves[0].context + halves[1].context)
    usable = bool(both.context[0].sum() and both.context[1].sum())
    shared = pages.sparkSession.sparkContext.broadcast(tuple(both))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for here, part in _slices(batches, 4):
            score = Models(*shared.value).scores(part) if usable else np.zeros(part.rows)
            rule = here.column(3)
            side = here.column(5).fill_null(2).to_numpy()
            allow = np.where(side == 2, score >= threshold, side == 0)
            yield pa.RecordBatch.from_arrays(
                [here.column(0), here.column(1), here.column(2), rule,
                 pa.array(np.where(allow, "allow", "block").tolist(), pa.string()), pa.array(score, pa.float64()),
                 pa.array(np.full(part.rows, threshold), pa.float64())],
                [id_col, "host", "path", "rule", "verdict", "score", "threshold"])

    kind = dict(pages.dtypes)[id_col]
    return rows.select("id", "host", "path", "rule", "text", "side").mapInArrow(
        run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string, score double, threshold double")
