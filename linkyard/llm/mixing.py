"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight that moves linearly from ``start`` to ``end`` over the
training time 0..1.  Its share of all words is the integral of that weight; a source
gives at most ``max_repeats`` times its words, and what it cannot give is shared
out among the others by weight until none is above.  The source's demand up to time t,
``D(t) = target * integral(weight, 0..t) / integral(weight, 0..1)``, is inverted:
the document whose middle word is the u-th word the source gives is read at
the time when D reaches u.  A source is read again from its first document when it
is used up, in the same order, and stops at the document whose middle passes the target.
The mix is the documents in range-sorted order of that time.

Order within a source: md5 of the key, then the size, then a hash of the row, so reruns agree.
Running sums go by ranges of that order, over slim rows without texts; equal rows are one row with a
count, so neither a source nor a repeated row of any share of the table is summed by one task.

Defined results: a null source is a source of its own, last; null and wordless texts have
size 0 and are never read; rows of equal key follow each other; an empty table mixes to an
empty table; other columns pass through (names must not start with ``_mx_``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranges import positions, running_sums
from .ship import ship, stored
from .textual import SPACED, doc_blocks, text_bytes, word_bounds

def _count_words(texts: pa.Array) -> pa.Array:
    data, off = text_bytes(texts)
    out = np.zeros(len(off) - 1, np.int64)
    for lo, hi in doc_blocks(off):
        _, _, doc = word_bounds(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo], SPACED)
        out[lo:hi] = np.bincount(doc, minlength=hi - lo)
    return pa.array(out, pa.int64())


def word_count(text: str) -> Column:
    """Number of words of a text column (null: 0), counted on Arrow bytes."""
    return F.arrow_udf(_count_words, T.LongType())(text)


def default_curriculum(rank: Column) -> tuple[Column, Column]:
    """Weights 1, 2, 3 by source rank, repeating; odd ranks fade in, even ranks fade out."""
    w = (rank % 3 + 1).cast("double")
    rising = rank % 2 == 0
    return F.when(rising, w * 0.5).otherwise(w * 1.5), F.when(rising, w * 1.5).otherwise(w * 0.5)


def source_targets(sizes: DataFrame, curriculum=default_curriculum, max_repeats: int = 3) -> DataFrame:
    """One row per source of ``sizes(_mx_source, _mx_size)``: its size, weights and target.

    Capped sources are those with the smallest ``cap / weight``; with the sources in that
    order, one running sum finds how many are capped.  The sums run over one row per source.
    """
    per = sizes.groupBy("_mx_source").agg(F.sum("_mx_size").cast("long").alias("_mx_source_size"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("_mx_source").asc_nulls_last())
    per = per.withColumn("_mx_rank", F.row_number().over(by_name) - 1)
    start, end = curriculum(F.col("_mx_rank"))
    per = per.withColumn("_mx_start", start).withColumn("_mx_end", end)
    per = per.withColumn("_mx_weight", (F.col("_mx_start") + F.col("_mx_end")) / 2)
    cap = F.col("_mx_source_size") * max_repeats
    order = Window.partitionBy(F.lit(0)).orderBy((cap / F.col("_mx_weight")).asc(), F.col("_mx_rank"))
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everyone = Window.partitionBy(F.lit(0))
    total = F.sum("_mx_source_size").over(everyone)
    per = per.withColumn("_mx_left", total - F.coalesce(F.sum(cap).over(before), F.lit(0)))
    per = per.withColumn("_mx_weights_left", F.sum("_mx_weight").over(rest))
    share = F.col("_mx_weight") * F.col("_mx_left") / F.col("_mx_weights_left")
    per = per.withColumn("_mx_capped", share >= cap)
    per = per.withColumn("_mx_open_left", F.max(F.when(~F.col("_mx_capped"), F.col("_mx_left"))).over(everyone))
    per = per.withColumn("_mx_open_weights", F.max(F.when(~F.col("_mx_capped"), F.col("_mx_weights_left"))).over(everyone))
    target = F.when(F.col("_mx_capped"), cap.cast("double")).otherwise(
        F.col("_mx_weight") * F.col("_mx_open_left") / F.col("_mx_open_weights"))
    return per.select("_mx_source", "_mx_source_size", "_mx_start", "_mx_end", target.alias("_mx_target"))


COPIES_AT_ONCE = 1000  # copies of one row that a task multiplies


def _row_id(names: list[str]) -> list[Column]:
    """Two 64-bit hashes over all columns: equal rows share them."""
    return [F.xxhash64(F.lit(7), *names).alias("_mx_row1"), F.xxhash64(*names).alias("_mx_row2")]


_ORDER = ["_mx_order", "_mx_size", "_mx_row1", "_mx_row2"]


def _per_row(docs: DataFrame, key: str, source: str, curriculum, max_repeats: int) -> DataFrame:
    """The plan without texts: one row per distinct row of ``docs``, with the number of its copies, the words its
    source gives before them, and what the source is to give."""
    ship(docs.sparkSession)
    names = docs.columns
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    tree = F.when(F.col(source).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(source).cast("string")))
    slim = docs.select(tree.alias("tree"), order.alias("_mx_order"), word_count("text").alias("_mx_size"), *_row_id(names),
                       F.col(key).alias("_mx_key"), F.col(source).alias("_mx_source"))
    slim = running_sums(slim, [*_ORDER, "_mx_key", "_mx_source"], "_mx_size")
    targets = source_targets(slim.select("_mx_source", (F.col("_mx_size") * F.col("n")).alias("_mx_size")), curriculum, max_repeats)
    of_tree = F.when(F.col("_mx_source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("_mx_source").cast("string")))
    targets = targets.withColumn("tree", of_tree).drop("_mx_source")
    return slim.join(targets, "tree").withColumnsRenamed({"n": "_mx_n", "before": "_mx_before", "tree": "_mx_tree"}).drop("total")


def _with_times(plan: DataFrame, max_repeats: int) -> DataFrame:
    """A row of the plan per copy (``_mx_copy``): how often it is read, and the training time of each reading."""
    first, last = F.lit(0).cast("long"), F.col("_mx_n") - 1
    if "_mx_chunk" in plan.columns:
        first = F.col("_mx_chunk") * COPIES_AT_ONCE
        last = F.least(last, first + COPIES_AT_ONCE - 1)
    rows = plan.withColumn("_mx_copy", F.explode(F.sequence(first, last)))
    rows = rows.withColumn("_mx_middle", F.col("_mx_before") + F.col("_mx_copy") * F.col("_mx_size") + F.col("_mx_size") / 2)
    reads = sum((F.when((F.col("_mx_size") > 0) & (F.col("_mx_source_size") * e + F.col("_mx_middle") < F.col("_mx_target")), 1).otherwise(0)
                 for e in range(max_repeats)), F.lit(0))
    rows = rows.withColumn("_mx_reads", reads)
    a, b = F.col("_mx_start"), F.col("_mx_end")

    def time_of(epoch: Column) -> Column:
        # D(t) / target = (a t + (b - a) t^2 / 2) / ((a + b) / 2) = u, solved for t.
        u = (F.col("_mx_source_size") * epoch + F.col("_mx_middle")) / F.col("_mx_target")
        return F.when(a == b, u).otherwise((F.sqrt(a * a + (b * b - a * a) * u) - a) / (b - a))

    times = F.transform(F.sequence(F.lit(0), F.col("_mx_reads") - 1), time_of)
    return rows.withColumn("_mx_times", F.when(F.col("_mx_reads") > 0, times).otherwise(F.array().cast("array<double>")))


def mix_plan(docs: DataFrame, key: str = "doc_id", source: str = "source", curriculum=default_curriculum,
             max_repeats: int = 3) -> DataFrame:
    """``docs`` with the size of each document, of its source, the source's target, the number of
    times it is read (``_mx_reads``) and the training time of each reading (``_mx_times``)."""
    names = docs.columns
    plan = stored(_per_row(docs, key, source, curriculum, max_repeats).drop("_mx_key", "_mx_source"), "mix-plan")
    # Equal rows meet as one (combined before the exchange), find their plan, and are multiplied again.
    rows = docs.withColumns({"_mx_row1": _row_id(names)[0], "_mx_row2": _row_id(names)[1]}).groupBy("_mx_row1", "_mx_row2").agg(
        F.any_value(F.struct(*[F.col(f"`{c}`") for c in names])).alias("_mx_fields"))
    rows = rows.join(plan, ["_mx_row1", "_mx_row2"])
    chunks = F.sequence(F.lit(0).cast("long"), F.expr(f"(_mx_n - 1) div {COPIES_AT_ONCE}"))
    many = rows.filter(F.col("_mx_n") > COPIES_AT_ONCE).withColumn("_mx_chunk", F.explode(chunks)).repartition("_mx_row1", "_mx_chunk")
    rows = _with_times(rows.filter(F.col("_mx_n") <= COPIES_AT_ONCE), max_repeats).unionByName(_with_times(many, max_repeats).drop("_mx_chunk"))
    return rows.select("_mx_fields.*", "_mx_size", "_mx_source_size", "_mx_target", "_mx_reads", "_mx_times", "_mx_tree", *_ORDER[2:], "_mx_order", "_mx_copy")


_TIE = ["_mx_order", "_mx_size", "_mx_tree", "_mx_row1", "_mx_row2", "_mx_copy"]


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix: ``docs``' rows, each as often as it is read, range-sorted by training time."""
    names = docs.columns
    plan = mix_plan(docs, **how).withColumn("_mx_time", F.explode("_mx_times"))
    return plan.repartitionByRange("_mx_time", *_TIE).sortWithinPartitions("_mx_time", *_TIE).select(*names)


def training_positions(readings: DataFrame) -> DataFrame:
    """``readings`` (``_mx_time`` and the columns of ``_TIE``) with ``pos``, the place of each in training, from 0."""
    return positions(readings.select(F.lit("").alias("tree"), "_mx_time", *_TIE), ["_mx_time", *_TIE])


def mix_report(docs: DataFrame, max_repeats: int = 3) -> DataFrame:
    """Per document: its size, its source's size and target, the words the mix takes from it, and its first
    position in training (null if it is never read).

    The mix itself runs here, but for the texts: every reading gets its training time, readings are
    range-sorted by it and numbered, and a document's words are counted from its readings.
    """
    plan = _per_row(docs.select("doc_id", "source", "text"), "doc_id", "source", default_curriculum, max_repeats)
    copies = stored(_with_times(plan, max_repeats).select(*_TIE, "_mx_key", "_mx_source_size", "_mx_target", "_mx_times"), "mix-copies")
    placed = training_positions(copies.select(*_TIE, F.explode("_mx_times").alias("_mx_time")))
    same = ["_mx_row1", "_mx_row2", "_mx_copy"]
    read = placed.groupBy(*same).agg(F.count(F.lit(1)).alias("reads"), F.min("pos").alias("first_position"))
    return copies.join(read, same, "left").select(
        F.col("_mx_key").alias("doc_id"), F.col("_mx_size").alias("size"), F.col("_mx_source_size").alias("source_size"),
        F.col("_mx_target").alias("target"), (F.col("_mx_size") * F.coalesce("reads", F.lit(0))).cast("long").alias("taken"), "first_position")


#: The same rows by DuckDB.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
p AS (SELECT *, CAST((SELECT sum(source_size) FROM s) - coalesce(sum(source_size * 3) OVER (
               ORDER BY source_size * 3 / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS room,
             sum(weight) OVER (ORDER BY source_size * 3 / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
c AS (SELECT *, weight * room / rest >= source_size * 3 AS capped FROM p),
t AS (SELECT source, source_size, weight, rank % 2 = 0 AS rising, CASE WHEN capped THEN CAST(source_size * 3 AS DOUBLE)
        ELSE weight * (SELECT max(room) FROM c WHERE NOT capped) / (SELECT max(rest) FROM c WHERE NOT capped) END AS target FROM c),
r AS (SELECT d.doc_id, d.size, d.source, d.o, t.source_size, t.target, t.rising, t.weight,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY o, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             + d.size / 2 AS middle, row_number() OVER () AS row FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT r.*, (source_size * epoch + middle) / target AS u, CASE WHEN rising THEN weight * 0.5 ELSE weight * 1.5 END AS a,
        CASE WHEN rising THEN weight * 1.5 ELSE weight * 0.5 END AS b FROM r, (SELECT range AS epoch FROM range(3)) WHERE size > 0 AND source_size * epoch + middle < target),
n AS (SELECT row, row_number() OVER (ORDER BY (sqrt(a * a + (b * b - a * a) * u) - a) / (b - a), o, size, source NULLS FIRST) - 1 AS pos FROM e),
f AS (SELECT row, min(pos) AS first_position, count(*) AS reads FROM n GROUP BY row)
SELECT doc_id, size, source_size, target, CAST(size * coalesce(reads, 0) AS BIGINT) AS taken, first_position
FROM r LEFT JOIN f USING (row)
"""
