"""Class counts over ``(obj_id, class)`` objects with explicit partition keys.

The reference counts classes in two MapReduce rounds: round 1 counts classes inside each
group of objects (groups = ``id % K``, ``id % floor(sqrt(K))`` or physical partitions),
round 2 sums those partial counts per class. Here both rounds are ``groupBy`` aggregations;
Catalyst adds a map-side partial aggregate before every shuffle, so only pre-aggregated
``(part, class)`` rows ever cross the network and a class holding a third of all rows
costs one row per map task. Results never depend on how the rows are placed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

SCHEMES = ("modulo", "sqrt", "physical")


def part_key(scheme: str, K: int, id_col: str = "obj_id") -> Column:
    """Partition key of an object.

    ``modulo``: ``id % K`` (Java remainder: keeps the sign of negative ids);
    ``sqrt``: ``id % floor(sqrt(K))``; ``physical``: the Spark partition holding the row.
    """
    if K < 1:
        raise ValueError("K must be >= 1")
    if scheme == "modulo":
        return F.col(id_col) % F.lit(int(K))
    if scheme == "sqrt":
        return F.col(id_col) % F.lit(int(math.isqrt(int(K))))
    if scheme == "physical":
        return F.spark_partition_id().cast("bigint")
    raise ValueError(f"unknown partition scheme {scheme!r}; use one of {SCHEMES}")


def with_parts(objects: DataFrame, K: int, scheme: str = "modulo", repartition: bool = False) -> DataFrame:
    """``(part, obj_id, class)``. ``repartition=True`` first spreads rows round-robin into K
    partitions (the reference's ``repartition(K)``); only the physical scheme observes it."""
    src = objects.repartition(int(K)) if repartition else objects
    return src.select(part_key(scheme, K).alias("part"), "obj_id", "class")


def class_partials(objects: DataFrame, K: int, scheme: str = "modulo", repartition: bool = False) -> DataFrame:
    """Round 1: ``(part, class, n)`` — how many objects of each class each part holds."""
    return (
        with_parts(objects, K, scheme, repartition)
        .groupBy("part", "class")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_count(objects: DataFrame, K: int, scheme: str = "modulo", repartition: bool = False) -> DataFrame:
    """Round 2: ``(class, n)`` sorted by class (the reference prints ``sortByKey`` output)."""
    return (
        class_partials(objects, K, scheme, repartition)
        .groupBy("class")
        .agg(F.sum("n").alias("n"))
        .orderBy("class")
    )


def part_sizes(objects: DataFrame, K: int, scheme: str = "modulo", repartition: bool = False) -> DataFrame:
    """``(part, part_total)``: objects per non-empty part."""
    return with_parts(objects, K, scheme, repartition).groupBy("part").agg(F.count(F.lit(1)).alias("part_total"))


def class_partition_stats(objects: DataFrame, K: int, scheme: str = "modulo", repartition: bool = False) -> DataFrame:
    """``(class, n, max_part)``: total count per class and the size of the largest part
    that holds at least one object of the class.

    Every partial ``(part, class, n)`` is paired with its part's total. The totals table
    has one row per non-empty part (objects with a NULL id form one): at most ``2K`` rows for
    the modulo schemes (ids may be negative) and one per Spark partition for ``physical``;
    Spark broadcasts it or not by its size.
    A window over ``part`` would instead buffer every class of a part in one task.
    """
    partials = class_partials(objects, K, scheme, repartition)
    totals = partials.groupBy("part").agg(F.sum("n").alias("part_total"))
    totals = totals.withColumnRenamed("part", "total_of")
    return (
        partials.join(totals, partials["part"].eqNullSafe(totals["total_of"]))
        .groupBy("class")
        .agg(F.sum("n").alias("n"), F.max("part_total").alias("max_part"))
        .orderBy("class")
    )


def max_partition_size(objects: DataFrame, K: int, scheme: str = "modulo", repartition: bool = False) -> DataFrame:
    """``(max_part)``: the most objects any single part handled (empty parts do not count).

    An empty input gives one row with NULL (the reference fails on empty input).
    """
    return part_sizes(objects, K, scheme, repartition).agg(F.max("part_total").alias("max_part"))


def most_frequent_class(objects: DataFrame, K: int = 1, scheme: str = "modulo", repartition: bool = False) -> DataFrame:
    """``(class, n)`` of the most frequent class; ties go to the smallest class name
    (the reference's pairwise reduce keeps an order-dependent one)."""
    counts = class_partials(objects, K, scheme, repartition).groupBy("class").agg(F.sum("n").alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col("class").asc()).limit(1)


def balanced_repartition(df: DataFrame, K: int) -> DataFrame:
    """Round-robin spread into K partitions and report ``(part, n)`` per partition."""
    if K < 1:
        raise ValueError("K must be >= 1")
    return (
        df.repartition(int(K))
        .select(F.spark_partition_id().alias("part"))
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def repartition_report(df: DataFrame, K: int) -> DataFrame:
    """``(parts, n, max_part, even_share, balanced)`` of a round-robin spread into K partitions:
    non-empty parts, rows, the largest part, ``ceil(n / K)``, and whether the largest part
    exceeds the even share by at most one row for each input partition (each deals its rows in
    turn, from a start of its own). An empty input has no parts and is balanced."""
    splits = df.rdd.getNumPartitions()
    sizes = balanced_repartition(df, K).agg(
        F.count(F.lit(1)).alias("parts"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("max_part"))
    share = F.ceil(F.col("n") / F.lit(int(K))).cast("bigint")
    return sizes.select("parts", "n", "max_part", share.alias("even_share"),
                        (F.col("max_part") - share <= F.lit(splits)).alias("balanced"))


SPREAD_BLOCK = 1 << 16   # hash buckets that number the rows


def dense_number(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` with ``_row``: 0 to n-1, one number a row, by hash bucket of the id, then id.

    Counts per bucket, prefix sums over the (at most SPREAD_BLOCK) buckets and a number within the bucket: no
    task sorts more than a bucket's rows, and the numbers do not depend on how the rows are placed. Rows of
    equal ids are numbered in any order among themselves, so ids should be distinct for a stable result.
    """
    bucket = F.pmod(F.xxhash64(F.col(id_col)), F.lit(SPREAD_BLOCK))
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most SPREAD_BLOCK rows: one task sums them up, and they are broadcast.
    before = counts.select("_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(id_col)) - 1
    return rows.withColumn("_inside", inside).join(F.broadcast(before), "_bucket").withColumn(
        "_row", F.col("_before") + F.col("_inside")).drop("_bucket", "_inside", "_before")


def even_spread(df: DataFrame, K: int, id_col: str = "obj_id") -> DataFrame:
    """``df`` with ``part``: K parts whose sizes differ by at most one row, ``part = row number * K div n``.

    Stable under retries and for any placement of the rows, where a round-robin ``repartition`` is neither even
    across its input tasks nor repeatable.
    """
    if K < 1:
        raise ValueError("K must be >= 1")
    numbered = dense_number(df, id_col)
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    n = total.first()["_total"]
    return numbered.withColumn("part", F.expr(f"(_row * {int(K)}L) div {max(1, int(n))}L")).drop("_row")


def even_spread_report(df: DataFrame, K: int, id_col: str = "obj_id") -> DataFrame:
    """``(part, n)`` of ``even_spread``, each part's rows counted."""
    return even_spread(df, K, id_col).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def observed_load(df: DataFrame, K: int, part_col: str | None = None) -> DataFrame:
    """``(parts, n, max_part)``: real Spark partitions with rows, rows, and the largest partition, observed while
    the rows pass (``DataFrame.observe``): no second job and no shuffle beside the one that deals the rows.

    ``part_col``: rows are put into the partition of this number (0 to K-1); without it they are dealt
    round-robin. A partition's rows are numbered as they pass (``monotonically_increasing_id`` counts within the
    partition), so the largest number, and the number of partitions that have a first row, are plain aggregates.
    """
    if K < 1:
        raise ValueError("K must be >= 1")
    dealt = df.repartitionById(int(K), F.col(part_col).cast("int")) if part_col else df.repartition(int(K))
    place = F.monotonically_increasing_id() % F.lit(1 << 33)
    seen = Observation()
    observed = dealt.select(place.alias("place")).observe(
        seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.max("place") + 1, F.lit(0)).alias("max_part"),
        F.coalesce(F.sum(F.when(F.col("place") == 0, 1)), F.lit(0)).alias("parts"))
    observed.write.format("noop").mode("overwrite").save()
    got = seen.get
    return df.sparkSession.createDataFrame(
        [(int(got["parts"]), int(got["n"]), int(got["max_part"]))], "parts bigint, n bigint, max_part bigint")
