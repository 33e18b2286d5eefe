"""Extendible hashing of documents into shards of a byte limit, with DataFrame operations only.

A document's key is 60 bits of the MD5 of its id and text, so copies under different ids and different
texts under one id spread alike. The directory starts with one bucket of depth 0; a bucket over the limit
splits on the next bit of the hash prefix, and only it. Rounds work off ``STEP_BITS`` bits at once: rows
of open buckets are summed by their next bits (at most 2**STEP_BITS partial sums an open bucket and task),
and the sums of all depths between follow from these. Buckets that still do not fit go on to the next round.

Defined results: a NULL text has 0 bytes, a NULL id is the empty string in the key; a bucket whose rows all
have one key cannot split: a text over the limit is a shard of its own with ``fits`` false, while exact
repeats of a row (same id, same text) are dealt over numbered shards that fit; an empty table gives no
rows. Extra columns are ignored by ``assign_shards`` and kept by ``write_shards``, which finds a row's shard by
its key alone, so NULL ids, repeated ids and repeated rows are written once each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispersa.llm.shared import written

HASH_BITS = 60
STEP_BITS = 10
COPY_BLOCK = 1 << 16  # copies of one row that a task numbers at once


def hash_bits(id_col: str, text_col: str) -> Column:
    """The first 60 bits of the key's MD5 as a non-negative long."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("/"),
                   F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def directory(keys: DataFrame, limit_bytes: int) -> DataFrame:
    """Leaves of the directory over ``keys`` (h, n_bytes): depth, prefix, shard_bytes, fits."""
    leaves: DataFrame | None = None
    inside = keys
    base = 0
    while True:
        top = min(base + STEP_BITS, HASH_BITS)
        fine = (inside.groupBy(F.shiftright("h", HASH_BITS - top).alias("fine"))
                .agg(F.sum("n_bytes").alias("s"), F.min("h").alias("lo"), F.max("h").alias("hi")))
        nodes = (fine.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(top))))
                 .groupBy("depth", F.expr(f"shiftright(fine, {top} - depth)").alias("prefix"))
                 .agg(F.sum("s").alias("shard_bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
                 .withColumn("done", (F.col("shard_bytes") <= limit_bytes) | (F.col("lo") == F.col("hi"))))
        nodes = written(nodes, "shard-directory")
        done = nodes.filter("done")
        above = done.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        new = (done.withColumn("parent", F.shiftright("prefix", 1))
               .join(above, ["depth", "parent"], "left_anti")
               .select("depth", "prefix", "shard_bytes", (F.col("shard_bytes") <= limit_bytes).alias("fits")))
        leaves = new if leaves is None else leaves.unionByName(new)
        still = nodes.filter((F.col("depth") == top) & ~F.col("done")).select(F.col("prefix").alias("open"))
        if top == HASH_BITS or still.isEmpty():
            return leaves
        inside = inside.join(still, F.shiftright(inside["h"], HASH_BITS - top) == still["open"], "left_semi")
        base = top


def _with_leaf(keys: DataFrame, leaves: DataFrame) -> DataFrame:
    """``keys`` (h) with their leaf (depth, prefix): one equal join for all depths, as a key asks at each depth that
    has a leaf (a few neighbouring ones)."""
    depths = sorted(r.depth for r in leaves.select("depth").distinct().collect()) or [0]  # 61 numbers at most
    asked = (keys.withColumn("depth", F.explode(F.array(*map(F.lit, depths))))
             .withColumn("prefix", F.expr(f"shiftright(h, {HASH_BITS} - depth)")))
    return asked.join(leaves, ["depth", "prefix"])


def assign_shards(docs: DataFrame, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, shard (the hash prefix as bits, and ``/k`` for the k-th shard of
    exact repeats), depth, shard_bytes and fits."""
    keys = written(docs.select(F.col(id_col).alias("id"), hash_bits(id_col, text_col).alias("h"),
                               F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
                   # Exact repeats of a row are one row with a count from here on.
                   .groupBy("id", "h", "n_bytes").agg(F.count(F.lit(1)).alias("copies")), "shard-keys")
    whole = keys.select("h", (F.col("n_bytes") * F.col("copies")).alias("n_bytes"))
    leaves = written(directory(whole, limit_bytes), "shard-leaves")
    found = _with_leaf(keys, leaves)
    # Repeats of one row that do not fit together: as many to a shard as fit, at least one.
    each = F.greatest(F.lit(1), F.floor(F.lit(limit_bytes) / F.greatest(F.col("n_bytes"), F.lit(1)))).cast("long")
    split = (~F.col("fits")) & (F.col("copies") > 1)
    named = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.expr("lpad(conv(prefix, 10, 2), depth, '0')"))
    # Copies are numbered in blocks, so no task unfolds all copies of a row.
    blocks = (found.withColumn("block", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPY_BLOCK})")))
              .repartition("id", "h", "block"))
    rows = (blocks.withColumn("copy", F.explode(F.expr(
                f"sequence(block * {COPY_BLOCK}, least(copies, (block + 1) * {COPY_BLOCK}) - 1)")))
            .withColumn("deal", F.when(split, F.floor(F.col("copy") / each)).cast("long")))
    dealt_bytes = F.least(each, F.col("copies") - F.col("deal") * each) * F.col("n_bytes")
    return rows.select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(split, F.concat(named, F.lit("/"), F.col("deal").cast("string"))).otherwise(named).alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        F.when(split, dealt_bytes).otherwise(F.col("shard_bytes")).alias("shard_bytes"),
        F.when(split, dealt_bytes <= limit_bytes).otherwise(F.col("fits")).alias("fits"))


def write_shards(docs: DataFrame, shards: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the documents, one folder per shard; ``shards`` is what ``assign_shards`` gave for them. Rows find the leaf
    of their key; rows of a leaf whose copies are dealt are numbered, and shard ``/k`` takes the k-th lot of them. A
    column ``shard`` of the documents stays, the folders are then named ``_shard``. Rows of a key that ``shards`` does
    not know go to a folder of their own, ``unassigned``. The shuffle key of the writing is the shard, whose size is bounded."""
    own = ["_h", "_bits", "_each", "_place", "_row", "_before", "shard"]
    while set(own) & set(docs.columns):
        own = ["_" + n for n in own]
    key, bits, each, place, row, before_col, folder = own
    parts = F.split("shard", "/")
    leaves = (shards.groupBy(parts[0].alias(bits), F.col("depth").cast("long").alias("depth"))
              .agg(F.sum(F.when(F.get(parts, F.lit(1)) == "0", 1)).alias(each))  # NULL: not dealt
              .withColumn("prefix", F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.conv(bits, 2, 10)).cast("long")))
    leaves = written(leaves, "shard-names")
    names = _with_leaf(docs.select(hash_bits(id_col, text_col).alias("h")).distinct(), leaves).select(
        F.col("h").alias(key), bits, each)
    # One small row a key; a key with very many copies is left to the skew join.
    found = docs.withColumn(key, hash_bits(id_col, text_col)).join(written(names, "shard-of-key"), key, "left")
    name = F.coalesce(F.concat(F.lit("s"), F.col(bits)), F.lit("unassigned"))
    out = found.filter(F.col(each).isNull()).select(*docs.columns, name.alias(folder))
    if not leaves.filter(F.col(each).isNotNull()).isEmpty():
        # A written table is read alike each time, so a row's number is its place in its partition after the
        # rows of earlier partitions.
        dealt = written(found.filter(F.col(each).isNotNull()), "shard-copies")
        placed = dealt.withColumn(place, F.spark_partition_id()).withColumn(row, F.monotonically_increasing_id())
        earlier = Window.partitionBy(key).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
        before = (placed.groupBy(key, place).agg(F.count(F.lit(1)).alias(row))
                  .select(key, place, F.coalesce(F.sum(row).over(earlier), F.lit(0)).alias(before_col)))
        number = F.row_number().over(Window.partitionBy(key, place).orderBy(row)) - 1
        numbered = placed.withColumn(row, number).join(before, [key, place])
        lot = F.expr(f"(`{row}` + `{before_col}`) div `{each}`").cast("string")
        out = out.unionByName(numbered.select(*docs.columns, F.concat(name, F.lit("-"), lot).alias(folder)))
    out.repartition(folder).write.partitionBy(folder).parquet(path)
