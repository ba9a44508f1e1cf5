"""Plan shape: no Python in any query, narrow flagship, reused exchange,
partial aggregation, pruned scans."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from linkyard.operators import assign_batches, classified_refs, file_refs, ref_counters
from linkyard.sources import file_inventory, order_lines

from .conftest import SF_MID

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonMapInArrow")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    """The adaptive plan after execution, final section only."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["file_refs", "page_refs", "batch_assign", "batch_counts", "run_result",
                                  "sample_20", "max_records_large", "network_counts", "reconcile", "url_parts",
                                  "format_hms", "scan_lines", "scan_text_lines", "gen_index_lines"])
def test_no_python_in_plans(spark, name):
    plan = _plan(E.queries()[name](spark, SF_MID))
    assert not any(node in plan for node in PYTHON_NODES), plan


def test_flagship_is_one_narrow_stage(spark):
    orders = spark.read.parquet(f"{SF_MID}/orders.parquet")
    # A wide input is not spread; then the whole chain has no exchange at all.
    lines = order_lines(orders.repartition(16))
    plan = _plan(file_refs(lines, "E").select("file_url"))
    after_spread = plan.split("Exchange")[0]
    assert "Generate posexplode" in after_spread and "regexp_extract_all" in after_spread
    assert plan.count("Exchange") == 1  # only the test's own repartition
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_prefix_sum_reuses_one_exchange(spark):
    lines = order_lines(spark.read.parquet(f"{SF_MID}/orders.parquet"))
    plan = _final_plan(assign_batches(lines, 10_000))
    assert "ReusedExchange" in plan
    # The regex is computed once, below the single hash exchange.
    assert plan.count("regexp_extract_all") == 2  # bare + keyed, once each in the final plan text


def test_counters_use_partial_aggregation(spark):
    lines = order_lines(spark.read.parquet(f"{SF_MID}/orders.parquet"))
    plan = _plan(ref_counters(classified_refs(lines)))
    assert "partial_count" in plan


def test_listing_reads_no_content(spark):
    plan = _plan(file_inventory(spark, SF_MID))
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_spread_follows_the_listing(spark, workdir):
    import random

    from linkyard.sources import read_lines, read_lines_raw

    from .fixtures import write_text, x1_lines

    path = write_text(f"{workdir}/one/index.json.gz", x1_lines(), gz=True)
    auto = _plan(read_lines(spark, path))
    assert "Exchange hashpartitioning(file_path" in auto and "line_no" in auto.split("Exchange hashpartitioning(file_path")[1][:80]
    assert "Exchange" not in _plan(read_lines_raw(spark, path, spread=False))
    assert "RoundRobinPartitioning" in _plan(read_lines_raw(spark, path))
    # As many gzip files as there are cores, all alike: the scan is wide already, also when named by a glob.
    cores = spark.sparkContext.defaultParallelism
    for k in range(2 * cores):
        write_text(f"{workdir}/wide/p{k:03d}.json.gz", x1_lines(), gz=True)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        wide = read_lines_raw(spark, f"{workdir}/wide/*.json.gz")
        assert wide.rdd.getNumPartitions() == 2 * cores and "Exchange" not in _plan(wide)
        # One large file among them: spread without a flag, into no fewer partitions than the scan has.
        rnd = random.Random(1)
        write_text(f"{workdir}/wide/q.json.gz", [str(rnd.random()) for _ in range(40_000)], gz=True)
        lopsided = read_lines_raw(spark, f"{workdir}/wide/*.json.gz")
        assert "RoundRobinPartitioning" in _plan(lopsided) and lopsided.rdd.getNumPartitions() >= 2 * cores + 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_path_given_twice_is_refused(spark, workdir):
    from linkyard.sources import read_lines, read_lines_raw

    from .fixtures import write_text

    path = write_text(f"{workdir}/twice/a.txt", ["x"])
    for read in (read_lines, read_lines_raw):
        with pytest.raises(ValueError):
            read(spark, [path, path])


def test_partitioned_write_adds_no_sort(spark, workdir):
    import datetime as dt
    import uuid

    from linkyard.sinks import ensure_table

    t = f"w_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, t, location=f"{workdir}/{t}")
    lines = order_lines(spark.read.parquet(f"{SF_MID}/orders.parquet"))
    refs = file_refs(lines, "E", "payer", "2025-05-01", dt.datetime(2025, 5, 1, tzinfo=dt.timezone.utc))
    view = f"v_{uuid.uuid4().hex[:8]}"
    refs.createOrReplaceTempView(view)
    cols = ", ".join(spark.table(t).columns)
    plan = spark.sql(f"EXPLAIN FORMATTED INSERT INTO {t} SELECT {cols} FROM {view}").first()[0]
    # One run writes one date: no per-task sort before the partitioned writer.
    assert "InsertIntoHadoopFsRelationCommand" in plan and "Sort" not in plan
