"""Spread a narrow or lopsided input over the cluster before the per-line work.

A gzip index is one split, so its scan is one task: decompression cannot be
split, but the regex work after it can.  Lines are spread by one exchange only
when the scan has fewer partitions than the cluster has cores, or when one file that
cannot be split holds more than ``LOPSIDED`` times a core's fair share of the bytes.
The exchange never has fewer partitions than the scan, and enough of them for
``SPREAD_BYTES`` of compressed text each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scan_partitions

# Compression suffixes Hadoop cannot split (one task per file).
UNSPLITTABLE_SUFFIXES = (".gz", ".zst", ".deflate", ".snappy", ".lz4")
LOPSIDED = 2
SPREAD_BYTES = 32 << 20


def unsplittable(path) -> "F.Column":
    """True for a path column that names a file Hadoop cannot split."""
    low = F.lower(path)
    return F.coalesce(*[F.when(low.endswith(x), True) for x in UNSPLITTABLE_SUFFIXES], F.lit(False))


@dataclass
class Layout:
    """What a listing says about input files: their number, bytes, the largest unsplittable one, distinct paths."""

    files: int
    total: int
    largest: int
    all_unsplittable: bool

    def lopsided(self, cores: int) -> bool:
        return self.largest * cores > LOPSIDED * max(1, self.total)


def layout_of(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> Layout:
    """The input's layout by one listing aggregate; no file is opened."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    fixed = unsplittable(F.col("path"))
    row = reader.load(paths).select("path", "length").agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)),
        F.coalesce(F.max(F.when(fixed, F.col("length"))), F.lit(0)), F.coalesce(F.min(fixed), F.lit(False))).first()
    return Layout(*row)


def spread_if_narrow(df: DataFrame, keys: list[str] | None = None,
                     min_partitions: int | None = None, current: int | None = None,
                     force: bool | None = None, layout: Layout | None = None) -> DataFrame:
    """Hash-spread on ``keys`` (unique line keys: even and deterministic without
    a sort); round-robin when there are none.  ``current`` is the known
    partition count of ``df`` (else it is read from a plan with no exchange).
    ``force``: True always spreads, False never, None decides by partitions and ``layout``."""
    spark = df.sparkSession
    cores = min_partitions or spark.sparkContext.defaultParallelism
    if force is False:
        return df
    n = current if current is not None else scan_partitions(df)
    if force is None:
        narrow = n is not None and n < cores
        if not narrow and not (layout is not None and layout.lopsided(cores)):
            return df
    target = max(cores, n or 0, -(-(layout.total if layout else 0) // SPREAD_BYTES))
    return df.repartition(target, *keys) if keys else df.repartition(target)
