"""The first references of text files, without opening more files than they need.

Files are taken in path order, one first, then the next two, four, eight, ...; a group's scan is cut
to its range of paths when the files are listed, so no other file is opened.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.lines import ordered_paths, read_lines_ordered
from .ordering import first_refs, indexed_refs
from .refs import extract_refs, filter_http, ref_key


def path_groups(spark: SparkSession, paths: str | list[str], line_sep: str | None = None) -> Iterator[tuple[str, DataFrame]]:
    """``(last path, lines)`` of each group of files."""
    files = ordered_paths(spark, paths)
    at, step = 0, 1
    while at < len(files):
        lo, hi = files[at], files[min(at + step, len(files)) - 1]
        yield hi, read_lines_ordered(spark, paths, line_sep, path_range=(lo, hi))
        at, step = at + step, step * 2


def _refs(lines: DataFrame) -> DataFrame:
    return filter_http(extract_refs(lines))


def first_file_refs(spark: SparkSession, paths: str | list[str], n: int, line_sep: str | None = None) -> DataFrame:
    """L1/L2 over files: the first ``n`` references by path and place, ranked.

    A top-k on references inside the scan tasks of each group, until ``n`` are found.  No line value leaves a task; the
    driver gets what is still missing of ``n`` references from each group.
    """
    got, empty = [], _refs(read_lines_ordered(spark, paths, line_sep)).limit(0)
    for _, lines in path_groups(spark, paths, line_sep):
        refs = _refs(lines)
        got += refs.orderBy(*ref_key(refs)).limit(n - len(got)).collect()
        if len(got) >= n:
            break
    return first_refs(spark.createDataFrame(got, empty.schema), n)


def cap_file_refs(spark: SparkSession, paths: str | list[str], max_records: int, line_sep: str | None = None) -> DataFrame:
    """L3 over files: the first ``max_records`` references by path and place; 0 keeps all.

    ``(file_path, split, record, pos, file_url)``.  The references of each group are counted until the cap is met; the files up to
    there are indexed in their scan tasks (``indexed_file_refs``), those behind them stay closed.
    """
    if max_records <= 0:
        return _refs(read_lines_ordered(spark, paths, line_sep))
    found, last = 0, None
    for last, lines in path_groups(spark, paths, line_sep):
        found += _refs(lines).count()
        if found >= max_records:
            break
    lines = read_lines_ordered(spark, paths, line_sep, path_range=None if last is None else ("", last))
    return indexed_refs(lines).where(F.col("ref_index") < max_records).drop("ref_index")
