"""Physical layout decisions taken at plan time from what Spark already knows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_to_cores(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores only if it has fewer input partitions
    than cores (e.g. one small file with a single row group). Large inputs already have
    many more splits than cores, so for them this is a no-op and adds no shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
