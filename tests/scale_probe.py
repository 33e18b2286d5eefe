"""Scale probe behind the README's 400k-point numbers (python tests/scale_probe.py [copies]).

Derives a larger point set from the sf0.1 embeddings — every point copied ``copies`` times
(default 200: 400,000 points of width 64) with a small per-copy shift, so ids stay unique
and points distinct — and times the point operators on it. Not a registered query.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    copies = int(argv[1]) if len(argv) > 1 else 200
    from pyspark.sql import functions as F

    from dispersa.operators import diameter, diversity, kcenter
    from dispersa.session import local_session
    from dispersa.sources import tables

    spark = local_session(8)
    emb = tables.embedding_points(spark, "/root/testdata/sf0.1")

    def derive(n_copies: int):
        return (
            emb.select("id", "p", F.explode(F.sequence(F.lit(0), F.lit(n_copies - 1))).alias("rep"))
            .select((F.col("id") * 1000 + F.col("rep")).alias("id"),
                    F.transform("p", lambda x: x + F.col("rep") * 1e-4).alias("p"))
            .repartition(16)
            .persist()
        )

    big = derive(copies)
    print("points", big.count(), flush=True)

    def timed(name, fn):
        t0 = time.perf_counter()
        result = fn()
        print(f"{name}: {time.perf_counter() - t0:.2f} s  {result}", flush=True)

    timed("k_center k=10", lambda: [r["id"] for r in kcenter.farthest_first(big, 10).orderBy("ord").collect()])
    timed("core_set k=5 L=4", lambda: diversity.core_set(big, 5, 4).count())
    timed("diversity_maximization k=6 L=8",
          lambda: sorted(r["id"] for r in diversity.diversity_maximization(big, 6, 8).collect()))
    timed("sampled_diameter k=16", lambda: diameter.sampled_diameter(big, 16).first()["max_dist"])
    smaller = derive(max(1, copies // 10))  # all pairs: 8e8 of them at the default size
    timed(f"farthest_pair of {smaller.count()} points", lambda: diameter.farthest_pair(smaller).first())
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
