"""Text index files as a lines DataFrame ``(file_path, line_no, value)``.

``spark.read.text`` gives lines but no line numbers.  A line's number in
its file is found without shuffling the lines:

* each input split ``(file_path, file_block_start)`` is read by one task,
  in file order, so ``monotonically_increasing_id()`` counts its lines;
* a small table with one row per split (first id, line count) gets each
  split's first line number from a running sum over the earlier splits of
  the same file;
* that table is joined back on the split key - broadcast when its row
  bound (input files + input partitions, both known before any job) is
  small, a shuffle join otherwise.

When every input file is non-splittable (gzip) and has a partition of its
own - the usual case for index files - the record number within the
partition is the line number, and the split table is skipped: one pass.

gzip files are not splittable (one split per file); plain text files
split by ``spark.sql.files.maxPartitionBytes`` and still number exactly.
The ids are recomputed identically when a task re-runs, because the split
planning depends only on the file listing.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import SPLIT_BROADCAST_ROWS
from .spread import layout_of, spread_if_narrow

# monotonically_increasing_id(): partition id in the upper 31 bits, record
# number within the partition in the lower 33 (as documented in the API).
RECORD_BITS = (1 << 33) - 1


def _reader(spark: SparkSession, line_sep: str | None):
    r = spark.read.format("text")
    if line_sep is not None:
        r = r.option("lineSep", line_sep)
    return r


def _check_paths(paths: str | list[str]) -> str | list[str]:
    """A path given twice would be read twice under one name: refuse it."""
    if not isinstance(paths, str) and len({p.rstrip("/") for p in paths}) != len(list(paths)):
        raise ValueError("the same path is given twice")
    return paths


def read_lines_raw(spark: SparkSession, paths: str | list[str], line_sep: str | None = None,
                   spread: bool | None = None) -> DataFrame:
    """``(file_path, value)`` without line numbers: the cheapest scan (S1).

    ``spread``: see ``read_lines``.
    """
    _check_paths(paths)
    df = _reader(spark, line_sep).load(paths)
    n_parts = df.rdd.getNumPartitions()
    df = df.select(F.col("_metadata.file_path").alias("file_path"), "value")
    layout = layout_of(spark, paths) if spread is None else None
    return spread_if_narrow(df, current=n_parts, force=spread, layout=layout)


def read_lines(
    spark: SparkSession,
    paths: str | list[str],
    line_sep: str | None = None,
    recursive: bool = False,
    spread: bool | None = None,
) -> DataFrame:
    """S1 + S2: ``(file_path, line_no BIGINT, value)``, ``line_no`` 0-based per file.

    ``paths`` may use any Hadoop scheme (``file://``, ``s3a://``, ``hdfs://``);
    the file system is chosen by the scheme.  ``.gz`` is read as gzip.
    ``line_sep`` cuts one huge line (a whole index on one line) into rows,
    e.g. ``"},"``; the default ends lines at LF, CRLF and CR.
    ``spread``: hash-spread the numbered lines before the per-line work.
    ``None`` spreads when the scan has fewer partitions than the cluster has
    cores, or the listing shows a file that cannot be split and holds far more
    than a core's share.
    """
    _check_paths(paths)
    reader = _reader(spark, line_sep)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    scan = reader.load(paths)
    n_parts = scan.rdd.getNumPartitions()
    n_files = len(scan._jdf.inputFiles())  # Py4J array: length read on the JVM side
    layout = layout_of(spark, paths, recursive)
    # Spark never plans an empty file partition, so equal counts mean one file per partition.
    if layout.all_unsplittable and n_files == n_parts:
        # Each partition is one whole non-splittable file read from its
        # start, so the record number in the partition is the line number:
        # one pass, no split table.
        lines = scan.select(
            F.col("_metadata.file_path").alias("file_path"),
            (F.monotonically_increasing_id().bitwiseAND(F.lit(RECORD_BITS))).alias("line_no"),
            "value",
        )
        return spread_if_narrow(lines, ["file_path", "line_no"], current=n_parts, force=spread, layout=layout)
    raw = scan.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_lk_split"),
        F.monotonically_increasing_id().alias("_lk_rid"),
        "value",
    )
    splits = raw.groupBy("file_path", "_lk_split").agg(
        F.min("_lk_rid").alias("_lk_rid0"), F.count(F.lit(1)).alias("_lk_n")
    )
    earlier = Window.partitionBy("file_path").orderBy("_lk_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "file_path", "_lk_split", "_lk_rid0",
        F.coalesce(F.sum("_lk_n").over(earlier), F.lit(0)).alias("_lk_first"),
    )
    # Bound on split count, known from the plan without a job: every split
    # is a whole file or one maxPartitionBytes piece of one.
    bound = n_files + n_parts
    if bound <= SPLIT_BROADCAST_ROWS:
        splits = F.broadcast(splits)
    # Beyond the bound: a shuffle join on the split key; AQE's skew-join
    # handling splits a hot file's partition and repeats its few split rows.
    lines = raw.join(splits, on=["file_path", "_lk_split"], how="inner").select(
        "file_path",
        (F.col("_lk_first") + F.col("_lk_rid") - F.col("_lk_rid0")).alias("line_no"),
        "value",
    )
    # The broadcast join keeps the scan's partitioning.
    return spread_if_narrow(lines, ["file_path", "line_no"], current=n_parts, force=spread, layout=layout)


def read_lines_ordered(spark: SparkSession, paths: str | list[str], line_sep: str | None = None,
                       recursive: bool = False, path_range: tuple[str, str] | None = None) -> DataFrame:
    """S1 without dense numbers: ``(file_path, split, record, value)`` from one scan, with no shuffle and no job.

    ``(file_path, split, record)`` orders lines as the files do: ``split`` is the byte where the line's input split
    begins, ``record`` rises along the split (it is not dense).  Whoever needs dense numbers asks ``with_ordinal`` or ``read_lines``.
    ``path_range``: only files whose path, as ``ordered_paths`` gives it, lies between the two; the others are left out when files are
    listed for the scan.
    """
    _check_paths(paths)
    reader = _reader(spark, line_sep)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    scan = reader.load(paths)
    if path_range is not None:
        # On the scan itself, below the record numbers: Spark prunes its file listing by it.
        scan = scan.where(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").between(*path_range))
    return scan.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("record"), "value")


def ordered_paths(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The input's files in path order, as ``path_range`` takes them: names that the listing holds on the driver anyway."""
    names = _reader(spark, None).load(_check_paths(paths)).inputFiles()
    # A local path is listed with one slash or with three.
    return sorted(re.sub("^file:/+", "file:/", n) for n in names)


def read_lines_stream(
    spark: SparkSession,
    directory: str,
    max_files_per_trigger: int | None = None,
    line_sep: str | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """T1 source: new files in ``directory`` as a stream of ``(file_path, value)``.

    Each file is read once per checkpoint; ``max_files_per_trigger`` is the
    micro-batch size (T2: text files have no row-count trigger).  ``spread`` deals each
    micro-batch's lines out to all cores; ``None`` does so when the files there now
    cannot be split and are fewer than the cores or lopsided.
    """
    r = spark.readStream.format("text")
    if line_sep is not None:
        r = r.option("lineSep", line_sep)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    lines = r.load(directory).select(F.col("_metadata.file_path").alias("file_path"), "value")
    cores = spark.sparkContext.defaultParallelism
    if spread is None:
        now = layout_of(spark, directory)
        per_batch = min(now.files, max_files_per_trigger or now.files)
        spread = now.all_unsplittable and now.files > 0 and (per_batch < cores or now.lopsided(cores))
    return lines.repartition(cores) if spread else lines
