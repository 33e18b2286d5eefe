"""Seeded, repeatable orderings of ids.

``portable_order`` is the ``md5('<seed>:<id>')`` order, which any SQL engine with
``md5`` reproduces exactly, so an oracle can pick the same sample. ``fast_order``
uses ``xxhash64`` and is what large jobs should use when no oracle is involved.
Both are deterministic per row, so task retries re-pick the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def portable_order(id_col: Column | str, seed: int) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{int(seed)}:"), c.cast("string")))


def fast_order(id_col: Column | str, seed: int) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.xxhash64(c, F.lit(int(seed)))
