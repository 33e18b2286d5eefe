"""Parquet table access for the test tables and the standard projections we run on.

Only the columns a query uses are selected, so the Parquet scan's ``ReadSchema`` is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as ``(obj_id BIGINT, class STRING)`` objects."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("obj_id"), F.col("event_type").alias("class")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as ``(id BIGINT, p ARRAY<DOUBLE>)``; floats widened to double first."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("p")
    )


def part_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part(p_size, p_retailprice)`` as 2-d points: many ties and exact duplicates."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double")).alias("p"),
    )


def order_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as 3-d points: customer number, total price, day since 1970."""
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.array(F.col("o_custkey").cast("double"), F.col("o_totalprice").cast("double"), day.cast("double")).alias("p"),
    )
