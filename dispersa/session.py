"""Session helpers: checkpoint folder resolution and a local session for tests/bench.

The library never configures the caller's session. The only session state it may
touch is the checkpoint folder, and only when none is configured in a local-mode
session (tests): on a cluster the folder must be the shared one the cluster names
in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session config if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="dispersa-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "no checkpoint folder: set spark.checkpoint.dir to a folder shared by the cluster"
    )


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder and return the re-read frame.

    Survives executor loss (the data is in shared storage), and truncates the plan so
    iterative loops do not grow their logical plans round after round.
    """
    checkpoint_dir(df.sparkSession)
    df.persist()  # the checkpoint write then reads the computed blocks instead of recomputing
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dispersa") -> SparkSession:
    """A local session for tests and the bench; never used by the library itself."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
