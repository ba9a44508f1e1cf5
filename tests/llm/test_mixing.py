"""Curriculum mix against DuckDB and against its own limits."""

from __future__ import annotations

from collections import Counter

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from linkyard.llm.mixing import MIX_SQL, mix_plan, mix_report, mixed


def _oracle(rows):
    con = duckdb.connect()
    df = pd.DataFrame([(r[0], r[1], r[3]) for r in rows], columns=["doc_id", "text", "source"])
    df["doc_id"] = df["doc_id"].astype("Int64")
    con.register("documents", df)
    return sorted(con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({MIX_SQL})").fetchall(), key=str)


def test_odd_rows_equal_sql(odd_docs, odd_rows):
    got = mix_report(odd_docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted((tuple(r) for r in got), key=str) == _oracle(odd_rows)


def test_no_rows(no_docs):
    assert mix_report(no_docs).count() == 0 and mixed(no_docs).count() == 0


def test_one_source_is_read_once(spark):
    docs = spark.createDataFrame([(i, "w " * i, "s") for i in range(1, 9)], "doc_id long, text string, source string")
    assert [r["taken"] for r in mix_report(docs).orderBy("doc_id").collect()] == list(range(1, 9))


def test_takes_come_near_targets_and_never_exceed_three(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mix_report(docs).collect()
    size, taken, target = Counter(), Counter(), {}
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    for r in rows:
        s = source[r["doc_id"]]
        size[s] = max(size[s], r["size"])
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= size[s] for s in target)
    assert sorted(tuple(r) for r in rows) == sorted(tuple(r) for r in mix_report(docs.repartition(7)).collect())


def test_mix_repeats_rows_in_training_order(odd_docs):
    plan = mix_plan(odd_docs)
    times = [t for r in plan.select("_mx_times").collect() for t in r[0]]
    assert all(0 <= t <= 1 for t in times)
    out = mixed(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == len(times)
    reads = {(r[0], r[1]): r[2] for r in plan.groupBy("doc_id", "text").agg(F.sum("_mx_reads")).collect() if r[2]}
    assert {(r[0], r[1]): r[2] for r in out.groupBy("doc_id", "text").count().collect()} == reads


def test_a_rising_source_comes_late(spark):
    docs = spark.createDataFrame([(i, "w", "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    plan = mix_plan(docs).select("source", F.explode("_mx_times").alias("t"))
    mean = {r["source"]: r["m"] for r in plan.groupBy("source").agg(F.avg("t").alias("m")).collect()}
    assert mean["a"] > 0.55 > 0.45 > mean["b"]  # rank 0 fades in, rank 1 fades out
