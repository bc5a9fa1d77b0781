"""Spark session construction and shared-storage helpers.

Cluster jobs read the checkpoint folder from ``spark.checkpoint.dir`` and fail
without it; a private folder is only made for local masters (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_spark(cpus: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "flowlens", extra: dict | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.driver.memory"] = os.environ.get("FLOWLENS_DRIVER_MEMORY", "8g")
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="flowlens-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{os.urandom(4).hex()}"


def persist_input(df: DataFrame) -> DataFrame:
    """Cache the input of a multi-pass fit; executor loss recomputes from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def swap_input(held: DataFrame | None, df: DataFrame) -> DataFrame:
    """Cache ``df``, which is made from the cached ``held`` (if any), in its place."""
    out = persist_input(df)
    out.count()
    if held is not None:
        held.unpersist()
    return out


PART_ROWS = 65_536


def persist_dealt(df: DataFrame) -> DataFrame:
    """Cache ``df`` in parts of about ``PART_ROWS`` rows if it comes in fewer parts than two per core.

    A file of one row group is one task, and without this it would be one task of every pass that follows.
    """
    held = persist_input(df)
    parts = -(-held.count() // PART_ROWS)
    if held.rdd.getNumPartitions() >= min(parts, 2 * df.sparkSession.sparkContext.defaultParallelism):
        return held
    dealt = persist_input(held.repartition(parts, *[F.col(f"`{x}`") for x in held.columns]))
    dealt.count()
    held.unpersist()
    return dealt
