"""The file-reference catalog table: create, probe, append, replace a date (K1-K6).

One run is one write job and one commit (not one commit per 10 000 rows):
each task writes its own files, the commit publishes them all or none, and
a lost task is simply re-run by the commit protocol.  Rows are counted on
the way into the writer with an ``Observation`` (A5), so "written" is what
the write job really saw, without a second pass.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schema import FILE_REFS_COLUMNS, FILE_REFS_SCHEMA, PARTITION_COLUMN, file_refs_ddl

MODES = ("append", "replace_date")


def ensure_table(spark: SparkSession, table: str, provider: str = "parquet",
                 location: str | None = None) -> str:
    """K1: ``CREATE TABLE IF NOT EXISTS``, partitioned by ``file_date``.

    ``provider`` is ``parquet`` by default, ``iceberg`` where its runtime is
    on the classpath.  ``location`` should be on shared storage.
    """
    spark.sql(file_refs_ddl(table, provider, location))
    if not table_exists(spark, table):
        raise RuntimeError(f"table {table} was not created")
    return table


# The partition column that names the batch a row came with, in a table that streams write to.
BATCH_COLUMN = "ingest_batch"


def ensure_stream_table(spark: SparkSession, table: str, provider: str = "parquet", location: str | None = None) -> str:
    """K1/T4: a table that takes whole batches at once.

    For Parquet, ``table`` is a view with the ten columns over ``<table>_batches``, which is partitioned by ``file_date``
    and by batch: a batch becomes visible when its partitions are added to the catalog, all in one statement.  Other
    providers commit atomically by themselves and get the plain table.
    """
    if provider.lower() != "parquet":
        return ensure_table(spark, table, provider, location)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FILE_REFS_SCHEMA.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {batches_name(table)} ({columns}, {BATCH_COLUMN} STRING) USING parquet "
              f"PARTITIONED BY ({PARTITION_COLUMN}, {BATCH_COLUMN}){place}")
    spark.sql(f"CREATE VIEW IF NOT EXISTS {table} AS SELECT {', '.join(FILE_REFS_COLUMNS)} FROM {batches_name(table)}")
    return table


def batches_name(table: str) -> str:
    return f"{table}_batches"


def takes_batches(spark: SparkSession, table: str) -> bool:
    """Whether ``table`` was made by ``ensure_stream_table`` for Parquet."""
    return table_exists(spark, batches_name(table)) and spark.catalog.getTable(table).tableType == "VIEW"


def published_batch(spark: SparkSession, table: str, batch: str) -> int | None:
    """The rows of a published batch; None if it isn't published."""
    parts = spark.sql(f"SHOW PARTITIONS {batches_name(table)} PARTITION ({BATCH_COLUMN} = '{batch}')")
    if parts.isEmpty():
        return None
    return spark.table(batches_name(table)).where(F.col(BATCH_COLUMN) == batch).count()


def write_batch_files(rows: DataFrame, table: str, batch: str) -> None:
    """The files of a batch, in the folders that its partitions will name; those of an earlier try go first.  Nothing is visible
    through the table yet."""
    spark = rows.sparkSession
    root = table_location(spark, batches_name(table)).rstrip("/")
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{PARTITION_COLUMN}=*/{BATCH_COLUMN}={batch}")
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for old in fs.globStatus(hpath) or []:
        fs.delete(old.getPath(), True)
    rows.withColumn(BATCH_COLUMN, F.lit(batch)).write.mode("append").partitionBy(PARTITION_COLUMN, BATCH_COLUMN).parquet(root)


def publish_batch(spark: SparkSession, table: str, batch: str) -> None:
    """Make a written batch part of ``table``: one statement adds all its partitions, where they lie.  Nothing is renamed; a
    reader of the table plans with all of them or with none."""
    root = table_location(spark, batches_name(table)).rstrip("/")
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{PARTITION_COLUMN}=*/{BATCH_COLUMN}={batch}")
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = sorted(f.getPath().getParent().getName().split("=", 1)[1] for f in fs.globStatus(hpath) or [])
    if days:
        spark.sql(f"ALTER TABLE {batches_name(table)} ADD " + " ".join(
            f"PARTITION ({PARTITION_COLUMN} = DATE '{d}', {BATCH_COLUMN} = '{batch}')" for d in days))


def table_exists(spark: SparkSession, table: str) -> bool:
    """K2: catalog lookup (False for a missing table or database)."""
    return spark.catalog.tableExists(table)


def is_v2(spark: SparkSession, table: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Provider").collect()
    return bool(rows) and rows[0]["data_type"].lower() not in ("parquet", "orc", "json", "csv", "text", "hive")


@dataclass
class WriteReport:
    table: str
    mode: str
    records_written: int
    metrics: dict = field(default_factory=dict)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str | None]):
    """Set session settings for one write and put the old values back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            if v is not None:
                spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def write_refs(df: DataFrame, table: str, mode: str = "append",
               metrics: dict[str, Column] | None = None,
               records_per_file: int | None = None,
               run_date: str | dt.date | None = None) -> WriteReport:
    """K3/K6: write 10-column file refs into ``table``, columns matched by name.

    ``append`` keeps every earlier row (a re-run doubles them, as re-running
    an append does); ``replace_date`` swaps only the ``file_date`` partitions
    present in ``df`` and keeps other dates.  With ``run_date`` that date is replaced even
    by a run without rows, which leaves it empty.  ``metrics`` are extra
    aggregates observed on the written rows in the same job.
    ``records_per_file`` caps rows per output file (the file-level form of a
    write batch; leave it unset for large runs, small files cost more).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark = df.sparkSession
    obs = Observation("linkyard_write")
    extra = [c.alias(name) for name, c in (metrics or {}).items()]
    rows = df.select(*FILE_REFS_COLUMNS).observe(obs, F.count(F.lit(1)).alias("written"), *extra)
    settings = {"spark.sql.files.maxRecordsPerFile": str(int(records_per_file)) if records_per_file else None}
    if takes_batches(spark, table):
        if mode != "append":
            raise ValueError("a table of ensure_stream_table takes appends only")
        batch = f"run-{uuid.uuid4().hex[:16]}"
        with session_conf(spark, settings):
            write_batch_files(rows, table, batch)
        publish_batch(spark, table, batch)
        spark.catalog.refreshTable(batches_name(table))
    elif is_v2(spark, table):
        with session_conf(spark, settings):
            writer = rows.writeTo(table)
            writer.append() if mode == "append" else writer.overwritePartitions()
    else:
        # v1 tables keep partition columns last and insertInto is positional,
        # so order the columns as the table has them.
        ordered = rows.select(*spark.table(table).columns)
        if mode == "replace_date":
            settings["spark.sql.sources.partitionOverwriteMode"] = "dynamic"
        with session_conf(spark, settings):
            ordered.write.insertInto(table, overwrite=(mode == "replace_date"))
    got = {k: int(v) for k, v in obs.get.items()}
    if mode == "replace_date" and run_date is not None and not got.get("written"):
        clear_date(spark, table, run_date)
    return WriteReport(table, mode, got.get("written", 0), got)


def clear_date(spark: SparkSession, table: str, run_date: str | dt.date) -> None:
    """Replace the partition of one date by no rows."""
    day = dt.date.fromisoformat(str(run_date))
    if is_v2(spark, table):
        spark.table(table).limit(0).writeTo(table).overwrite(F.col(PARTITION_COLUMN) == F.lit(day))
        return
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
                        for f in spark.table(table).schema.fields if f.name != PARTITION_COLUMN)
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({PARTITION_COLUMN} = DATE '{day}') SELECT {nothing} WHERE 1 = 0")


def table_location(spark: SparkSession, table: str) -> str:
    """Where the table's files are."""
    return spark.sql(f"DESCRIBE FORMATTED {table}").where(F.col("col_name") == "Location").first()["data_type"]


def committed_files(spark: SparkSession, table: str, file_date: str | dt.date | None = None) -> DataFrame:
    """``(file, n_rows)`` of the files the table consists of now, counted from their footers (no column is read)."""
    t = spark.table(table)
    if file_date is not None:
        t = t.where(F.col(PARTITION_COLUMN) == F.lit(str(file_date)).cast("date"))
    return t.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))


def table_rows(spark: SparkSession, table: str, file_date: str | None = None) -> DataFrame:
    """The table, optionally one ``file_date`` (partition-pruned)."""
    t = spark.table(table)
    if file_date is not None:
        t = t.where(F.col(PARTITION_COLUMN) == F.lit(file_date).cast("date"))
    return t.select(*FILE_REFS_COLUMNS)
