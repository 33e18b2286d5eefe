"""Connected components of links, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispersa.llm.shared import written


def connected(links: DataFrame) -> DataFrame:
    """(c, label) for every end of the links (a, b): the label is the smallest end of the component.

    Each round takes the smallest label among a node and its neighbours, then the label of that label, so
    the distance to the smallest node shrinks by more than one link a round. Rounds are written to the
    shared folder; a node with very many links is aggregated before the shuffle and its joins can be split.
    """
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(edges.filter("a != b").distinct(), "edges")
    labels = written(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
                     .withColumnRenamed("a", "c"), "labels")
    while True:
        near = (edges.join(labels, edges["b"] == labels["c"]).groupBy("a").agg(F.min("label").alias("near")))
        own = labels.join(near, labels["c"] == near["a"]).select("c", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("c").alias("next"), F.col("label").alias("beyond"))
        moved = written(own.join(jump, "next").select("c", F.least("next", "beyond").alias("label"),
                                                      (F.least("next", "beyond") < F.col("label")).alias("moved")), "labels")
        done = moved.filter("moved").isEmpty()
        labels = moved.select("c", "label")
        if done:
            return labels
