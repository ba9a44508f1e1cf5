"""Places and running sums over a total order, by ranges instead of one task.

Rows are range-sorted, summed in each range, and ranges get their base from a running sum over the
ranges.  Equal rows are one row with a count before that, so no repeated row makes a range large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ship import partitions_for, stored

ROW_BYTES, RANGE_BYTES = 120, 16e6


def running_sums(rows: DataFrame, order: list[str], weight: str | None = None, range_bytes: float = RANGE_BYTES) -> DataFrame:
    """``(tree, *order, n, before, total)`` of ``rows`` (``tree``, never null, and the columns of ``order``).

    One row per distinct row: ``n`` times it is there, ``before`` is the sum of ``weight`` (a column of ``order``;
    None: 1 each) over all rows of its tree before the first of them, ``total`` that of the whole tree.  Stored twice.
    """
    slim = stored(rows.groupBy("tree", *order).agg(F.count(F.lit(1)).alias("n")), "ranges-rows")
    ranges = partitions_for(slim.count() * ROW_BYTES, range_bytes)
    ranged = stored(slim.repartitionByRange(ranges, "tree", *order).withColumn("rng", F.spark_partition_id()), "ranges-sorted")
    each = F.col("n") if weight is None else F.col("n") * F.col(weight)
    # One row per range and tree: what the ranges before hold of the tree, and the tree's total.
    by_tree = Window.partitionBy("tree")
    heads = ranged.groupBy("tree", "rng").agg(F.sum(each).alias("in_range")).select(
        "tree", "rng", F.sum("in_range").over(by_tree).alias("total"),
        F.coalesce(F.sum("in_range").over(by_tree.orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    above = Window.partitionBy("tree", "rng").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("above", F.coalesce(F.sum(each).over(above), F.lit(0))).join(heads, ["tree", "rng"])
            .select("tree", *order, "n", (F.col("base") + F.col("above")).alias("before"), "total"))


def positions(rows: DataFrame, order: list[str], range_bytes: float = RANGE_BYTES) -> DataFrame:
    """``rows`` (``tree`` and the columns of ``order``) with ``pos``, a row's place in its tree in that order, from 0, and
    ``size``, the tree's number of rows.  Equal rows are numbered one after the other."""
    return running_sums(rows, order, None, range_bytes).select(
        "tree", *order, F.col("total").alias("size"), F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("pos"))
