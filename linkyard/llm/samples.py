"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_of_each(rows: DataFrame, keys: list[str], values: list[str], most: int) -> DataFrame:
    """``(*keys, *values)``: at most ``most`` rows, one for each of the ``keys`` with the smallest hashes.

    Of rows with the same keys the one with the least hash of its values is taken (found by a partial aggregate, so a key that
    repeats without bound still is one row), and texts are only fetched for the chosen ones.  A null key is a key.
    """
    spark = rows.sparkSession
    which = F.xxhash64(*values)
    chosen = (rows.groupBy(*keys).agg(F.min(which).alias("_sm_row")).orderBy(F.xxhash64(*keys), *keys).limit(most))
    # ``most`` rows of keys and a hash: bounded by the parameter, so they may be broadcast.
    found = spark.createDataFrame(chosen.collect(), chosen.schema).withColumnsRenamed({k: f"_sm_{k}" for k in keys})
    same = F.col("_sm_hash") == F.col("_sm_row")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_sm_{k}"))
    met = rows.withColumn("_sm_hash", which).join(F.broadcast(found), same)
    # Equal rows are one again: the copies meet in a partial aggregate.
    return met.groupBy(*keys).agg(*[F.any_value(v).alias(v) for v in values]).select(*keys, *values)


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, key: str = "doc_id") -> DataFrame:
    """``(key, label, text)`` of at most ``most`` keys that have a label and a row in ``docs``, one row per key.

    A key with several labels takes the largest; of its several texts the one with the least hash is taken.  Null keys have no label.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(F.col(label).cast("int")).alias("label"))
    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), "text")
    # Keys first, without texts: labels and documents of the same keys, then the smallest hashes.
    keys = rows.select("key").join(known, "key", "left_semi").distinct().orderBy(F.xxhash64("key"), "key").limit(most)
    keys = rows.sparkSession.createDataFrame(keys.collect(), keys.schema)  # bounded by the parameter
    some = one_of_each(rows.join(F.broadcast(keys), "key", "left_semi"), ["key"], ["text"], most)
    return some.join(F.broadcast(known.join(F.broadcast(keys), "key", "left_semi")), "key").select("key", "label", "text")
