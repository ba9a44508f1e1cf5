"""Sending the package's code to the executors, and tables cut from their lineage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_sent: set[str] = set()


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 1000  # rows of whole texts per Arrow batch


def ship(spark: SparkSession) -> None:
    """Give the executors this package once per application (``addPyFile``),
    so workers can import it wherever they run.

    Rows of whole texts are large: a session that names no number of rows per Arrow batch gets ``TEXT_ROWS`` (for good,
    since results are computed after the operator has returned).  A number that was set stays, whatever it is."""
    sc = spark.sparkContext
    if ARROW_ROWS not in spark.conf.getAll:
        spark.conf.set(ARROW_ROWS, str(TEXT_ROWS))
    if sc.applicationId in _sent:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="linkyard-code-"), "linkyard_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("linkyard", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _sent.add(sc.applicationId)


def stored(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back: its lineage ends in files that every executor can reach."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    w = df.write.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(n_bytes: float, per_partition: float, least: int = 1) -> int:
    """How many partitions of about ``per_partition`` bytes hold ``n_bytes``."""
    return int(max(least, -(-n_bytes // per_partition)))
