"""Where the library may write intermediate and scratch data.

On a cluster the only safe place is the shared folder named by
``spark.checkpoint.dir`` (or set with ``SparkContext.setCheckpointDir``);
a machine-local temp folder would vanish with the executor that wrote it.
A folder is only made up here when the session names none (tests, local).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Row bound below which a table with one row per input split is broadcast (about 100 bytes a row).
SPLIT_BROADCAST_ROWS = 1_000_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        # Unset: local runs and tests only, where driver and executor are one process.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="linkyard-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return sc.getCheckpointDir()


def stable_checkpoint_root(spark: SparkSession) -> str:
    """The folder as configured: the same in every run, unlike the per-run folder Spark makes below it."""
    checkpoint_dir(spark)
    return (spark.conf.get("spark.checkpoint.dir", None) or os.path.dirname(checkpoint_dir(spark))).rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/linkyard/{tag}-{uuid.uuid4().hex[:12]}"


def unique_table_name(tag: str) -> str:
    return f"linkyard_{tag}_{uuid.uuid4().hex[:10]}"


def scan_partitions(df: DataFrame) -> int | None:
    """Partition count of ``df`` if its plan has no exchange, else None.

    Building the RDD of a plan with a shuffle or broadcast would run those
    stages, and such a plan is distributed by its exchange anyway.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return None
    return df.rdd.getNumPartitions()
