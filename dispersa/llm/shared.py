"""Shared helpers: tables written to the cluster's shared folder, and caches that live as long as a
Python worker."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from dispersa.session import checkpoint_dir


ARROW_ROWS, ARROW_BYTES = 2_000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches between executors and Python workers for tables of long texts: the default
    of 10,000 rows is some 40 MB of documents, held several times over. Called by the queries and the
    pipeline's stages, not by the operators."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: the plan is cut and the rows
    survive the loss of any executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """``make()`` once per Python worker process and key. Spark reuses workers for many tasks but
    unpickles the task's functions each time, so what should outlive a task is kept in a module object."""
    store = sys.modules.setdefault("_dispersa_worker_cache", types.ModuleType("_dispersa_worker_cache")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def release_worker() -> None:
    """Drops what ``per_worker`` keeps in this process: for tasks of operators without a cache, whose workers
    may have served an encoder before."""
    store = sys.modules.get("_dispersa_worker_cache")
    if store is not None:
        for key in [k for k in vars(store) if isinstance(k, tuple)]:
            del vars(store)[key]


class RecentCache:
    """A mapping of bounded size in two generations: when the young one is full it becomes the old one,
    and what is asked for again returns from the old one. Only saves work; results do not depend on it."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def get_all(self, keys: list, make: Callable[[list], Iterable]) -> list:
        """Values of ``keys`` in order; ``make`` gets the distinct missing keys and returns their values."""
        found = list(map(self.young.get, keys))
        gaps = [i for i, v in enumerate(found) if v is None]
        if not gaps:
            return found
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        ask = []
        for k in {keys[i] for i in gaps}:
            v = old.get(k)
            if v is None:
                ask.append(k)
            else:
                young[k] = v
        if ask:
            young.update(zip(ask, make(ask)))
        for i in gaps:
            found[i] = young[keys[i]]
        return found
