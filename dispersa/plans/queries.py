"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the whole given tables. Distances are rounded to ``DIGITS`` places so a
second engine can be compared value by value (last-bit sums differ between engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispersa.plans.layout import spread_to_cores
from dispersa.operators import counts, diameter, diversity, kcenter, pairs, words
from dispersa.sources import tables
from dispersa.sources import text as text_src

# Fixed parameters of the catalogue.
K = 4            # partitions for class counts
K_SQRT = 16      # class_count_sqrt: floor(sqrt(16)) = 4 groups
K_SPREAD = 7     # balanced_repartition
L = 4            # core-set parts
CHUNKS = 3       # chunks of a part in the merged core-set
k = 5            # points per answer (centres, sample size, matching size)
SEED = 42        # portable sample seed
DIGITS = 6
ROUNDS = 4       # matchings of the pair-distance estimate
DRAWS = 20       # draws with replacement
FLAGSHIP = "diversity_maximization"  # what entry() runs: the reference's end-to-end pipeline

Query = Callable[[SparkSession, str], DataFrame]


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return words.lines(spread_to_cores(tables.documents(spark, sf)))


# --- class counts -------------------------------------------------------------------------

def q_parse_object_class(spark, sf):
    ev = tables.table(spark, sf, "events")
    return text_src.parse_object_class(text_src.format_object_lines(ev, "event_id", "event_type"))


def q_balanced_repartition(spark, sf):
    return counts.even_spread_report(tables.objects(spark, sf), K_SPREAD)


def q_class_partials(spark, sf):
    return counts.class_partials(tables.objects(spark, sf), K, "modulo")


def q_class_count_modulo(spark, sf):
    return counts.class_count(tables.objects(spark, sf), K, "modulo")


def q_class_count_sqrt(spark, sf):
    return counts.class_count(tables.objects(spark, sf), K_SQRT, "sqrt")


def q_class_count_physical(spark, sf):
    return counts.class_count(tables.objects(spark, sf), K, "physical", repartition=True)


def q_class_partition_stats(spark, sf):
    return counts.class_partition_stats(tables.objects(spark, sf), K, "modulo")


def q_max_partition_size(spark, sf):
    return counts.max_partition_size(tables.objects(spark, sf), K, "modulo")


def q_max_partition_size_physical(spark, sf):
    """The largest real Spark partition of an even spread, observed while the rows pass."""
    spread = counts.even_spread(tables.objects(spark, sf), K)
    return counts.observed_load(spread, K, "part")


def q_most_frequent_class(spark, sf):
    return counts.most_frequent_class(tables.objects(spark, sf), K, "modulo")


# --- words --------------------------------------------------------------------------------

def q_text_lines(spark, sf):
    return _lines(spark, sf)


def q_document_count(spark, sf):
    return words.blob_line_count(spread_to_cores(tables.documents(spark, sf)))


def q_doc_term_frequency(spark, sf):
    return words.doc_term_frequency(_lines(spark, sf))


def q_word_count(spark, sf):
    return words.word_count(_lines(spark, sf))


def q_word_count_salted(spark, sf):
    return words.word_count_salted(_lines(spark, sf), K, seed=SEED)


def q_word_count_partitioned(spark, sf):
    return words.word_count_partitioned(_lines(spark, sf))


def q_distinct_word_count(spark, sf):
    return words.distinct_word_count(_lines(spark, sf))


def q_average_word_length(spark, sf):
    return words.average_word_length(words.word_count(_lines(spark, sf)))


# --- points -------------------------------------------------------------------------------

def _pts(spark: SparkSession, sf: str) -> DataFrame:
    return tables.embedding_points(spark, sf)


def _r(col: str) -> "F.Column":
    return F.round(F.col(col), DIGITS).alias(col)


def q_parse_points(spark, sf):
    lines = text_src.format_point_lines(tables.table(spark, sf, "part"), "p_partkey", ["p_size", "p_retailprice"])
    pts = text_src.parse_points(lines)
    return pts.select("id", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"), F.size("p").alias("dim"))


def q_point_distances(spark, sf):
    pts = _pts(spark, sf)
    d = diameter.distances_to_set(pts, diameter.sample_points(pts, k, SEED))
    return d.select("i", "j", _r("sqdist"), _r("dist"))


def q_point_set_summary(spark, sf):
    return diameter.point_set_summary(_pts(spark, sf), k, L)


def q_exact_diameter(spark, sf):
    return diameter.exact_diameter(_pts(spark, sf)).select(_r("max_dist"))


def q_sampled_diameter(spark, sf):
    return diameter.sampled_diameter(_pts(spark, sf), k, SEED).select(_r("max_dist"))


def q_min_distance_to_centers(spark, sf):
    pts = _pts(spark, sf)
    return diameter.min_distance_to_set(pts, diameter.sample_points(pts, k, SEED)).select("id", _r("min_dist"))


def q_k_center(spark, sf):
    return kcenter.farthest_first(_pts(spark, sf), k).select("ord", "id", _r("min_dist"))


def q_k_center_diameter(spark, sf):
    return diameter.k_center_diameter(_pts(spark, sf), k).select(_r("max_dist"))


def q_coreset_k_center(spark, sf):
    return diversity.core_set(_pts(spark, sf), k, L).select("part", "ord", "id", _r("min_dist"))


def q_coreset_merged(spark, sf):
    return diversity.core_set_merged(_pts(spark, sf), k, L, CHUNKS).select("part", "ord", "id", _r("min_dist"))


def q_farthest_pair(spark, sf):
    return diameter.farthest_pair(_pts(spark, sf)).select("i", "j", _r("dist"))


def q_greedy_matching(spark, sf):
    return diversity.greedy_matching(_pts(spark, sf), k).select("round", "id")


def q_average_pairwise_distance(spark, sf):
    return pairs.average_pairwise_distance(_pts(spark, sf)).select(_r("avg_dist"))


def q_estimated_pairwise_distance(spark, sf):
    est = pairs.estimate_average_distance(_pts(spark, sf), rounds=ROUNDS, seed=SEED)
    return est.select(_r("avg_dist"), _r("error_bound"), "n_pairs")


def q_sample_with_replacement(spark, sf):
    return diameter.sample_with_replacement(_pts(spark, sf), DRAWS, SEED).select("draw", "id")


def q_replaced_sample_diameter(spark, sf):
    return diameter.replaced_sample_diameter(_pts(spark, sf), DRAWS, SEED).select(_r("max_dist"))


def q_diversity_maximization(spark, sf):
    return diversity.diversity_maximization(_pts(spark, sf), k, L).select("round", "id")


def q_diversity_score(spark, sf):
    answer = diversity.diversity_maximization(_pts(spark, sf), k, L)
    return diversity.diversity_score(answer).select(_r("avg_dist"))


# 2-d points (part: size, retail price) — the reference's diameter program works on 2-d
# points; this set has exact duplicates and distance ties, and prunes well.

def _pts2(spark: SparkSession, sf: str) -> DataFrame:
    return tables.part_points(spark, sf)


def q_exact_diameter_2d(spark, sf):
    return diameter.exact_diameter(_pts2(spark, sf)).select(_r("max_dist"))


def q_farthest_pair_2d(spark, sf):
    return diameter.farthest_pair(_pts2(spark, sf)).select("i", "j", _r("dist"))


def q_farthest_pair_orders(spark, sf):
    """3-d points (customer, price, day): more than a block, so they go through the ball tree."""
    pts = tables.order_points(spark, sf)
    return diameter.farthest_pair(pts).select("i", "j", _r("dist"))


def q_k_center_2d(spark, sf):
    return kcenter.farthest_first(_pts2(spark, sf), k).select("ord", "id", _r("min_dist"))


QUERIES: dict[str, Query] = {
    "parse_object_class": q_parse_object_class,
    "balanced_repartition": q_balanced_repartition,
    "class_partials": q_class_partials,
    "class_count_modulo": q_class_count_modulo,
    "class_count_sqrt": q_class_count_sqrt,
    "class_count_physical": q_class_count_physical,
    "class_partition_stats": q_class_partition_stats,
    "max_partition_size": q_max_partition_size,
    "max_partition_size_physical": q_max_partition_size_physical,
    "most_frequent_class": q_most_frequent_class,
    "text_lines": q_text_lines,
    "document_count": q_document_count,
    "doc_term_frequency": q_doc_term_frequency,
    "word_count": q_word_count,
    "word_count_salted": q_word_count_salted,
    "word_count_partitioned": q_word_count_partitioned,
    "distinct_word_count": q_distinct_word_count,
    "average_word_length": q_average_word_length,
    "parse_points": q_parse_points,
    "point_distances": q_point_distances,
    "point_set_summary": q_point_set_summary,
    "exact_diameter": q_exact_diameter,
    "sampled_diameter": q_sampled_diameter,
    "min_distance_to_centers": q_min_distance_to_centers,
    "k_center": q_k_center,
    "k_center_diameter": q_k_center_diameter,
    "coreset_k_center": q_coreset_k_center,
    "coreset_merged": q_coreset_merged,
    "farthest_pair": q_farthest_pair,
    "greedy_matching": q_greedy_matching,
    "average_pairwise_distance": q_average_pairwise_distance,
    "estimated_pairwise_distance": q_estimated_pairwise_distance,
    "sample_with_replacement": q_sample_with_replacement,
    "replaced_sample_diameter": q_replaced_sample_diameter,
    "diversity_maximization": q_diversity_maximization,
    "diversity_score": q_diversity_score,
    "exact_diameter_2d": q_exact_diameter_2d,
    "farthest_pair_2d": q_farthest_pair_2d,
    "farthest_pair_orders": q_farthest_pair_orders,
    "k_center_2d": q_k_center_2d,
}
