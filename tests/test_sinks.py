"""Catalog table: DDL, existence, append, replace a date, run result, report."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from linkyard.operators import classified_refs, reconcile
from linkyard.plans import ExtractionConfig, extract_index_file, run_extraction, write_summary
from linkyard.schema import FILE_REFS_COLUMNS, file_refs_ddl
from linkyard.sinks import ensure_table, table_exists, table_rows, write_refs
from linkyard.operators import file_refs

from .fixtures import write_text, x1_lines


def _lines(spark):
    return spark.createDataFrame(list(enumerate(x1_lines())), "line_no long, value string")


def _table(spark, workdir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, name, location=f"{workdir}/{name}")
    return name


def test_ddl_text_and_created_table(spark, workdir):
    ddl = file_refs_ddl("db.t", "iceberg")
    assert "USING iceberg" in ddl and "PARTITIONED BY (file_date)" in ddl and "extracted_ts TIMESTAMP" in ddl
    t = _table(spark, workdir)
    assert table_exists(spark, t)
    assert not table_exists(spark, "no_such_table_here")
    assert sorted(spark.table(t).columns) == sorted(FILE_REFS_COLUMNS)
    ensure_table(spark, t, location=f"{workdir}/{t}")  # idempotent


def test_append_by_name_and_rerun_doubles(spark, workdir):
    t = _table(spark, workdir)
    refs = file_refs(_lines(spark), "E", "payer", "2025-05-01", "2025-05-01 00:00:00")
    rep = write_refs(refs, t)
    assert rep.records_written == 200
    # Column order in the table differs (partition column last); values land by name.
    got = table_rows(spark, t).where(F.col("file_url").endswith("file1.json")).first()
    assert (got["file_network"], got["file_type"], str(got["file_date"])) == ("allowed-amount", "json", "2025-05-01")
    write_refs(refs, t)
    assert spark.table(t).count() == 400


def test_replace_date_keeps_other_dates(spark, workdir):
    t = _table(spark, workdir)
    lines = _lines(spark)
    write_refs(file_refs(lines, "E", "payer", "2025-04-01", "2025-04-01 00:00:00"), t)
    for _ in range(2):
        write_refs(file_refs(lines, "E", "payer", "2025-05-01", "2025-05-01 00:00:00"), t, "replace_date")
    per_date = {str(r["file_date"]): r["count"] for r in spark.table(t).groupBy("file_date").count().collect()}
    assert per_date == {"2025-04-01": 200, "2025-05-01": 200}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"
    # Partition pruning on the date.
    plan = table_rows(spark, t, "2025-04-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_date" in plan


def test_replace_date_with_nothing_clears_the_date(spark, workdir):
    t = _table(spark, workdir)
    lines = _lines(spark)
    for day in ("2025-04-01", "2025-05-01"):
        write_refs(file_refs(lines, "E", "payer", day, f"{day} 00:00:00"), t)
    none = file_refs(lines.where("false"), "E", "payer", "2025-05-01", "2025-05-01 00:00:00")
    assert write_refs(none, t, "replace_date", run_date="2025-05-01").records_written == 0
    assert {str(r["file_date"]): r["count"] for r in spark.table(t).groupBy("file_date").count().collect()} == {"2025-04-01": 200}
    # The whole job, replacing with lines that hold nothing.
    cfg = ExtractionConfig(table=t, entity_name="E", mode="replace_date", as_of="2025-04-01", as_of_ts="2025-04-01 00:00:00")
    run = run_extraction(spark, spark.createDataFrame([(0, "no link")], "line_no long, value string"), cfg)
    assert run.counters["written"] == 0 and run.result.first()["sample_urls"] == [] and spark.table(t).count() == 0


def test_run_result_reconcile_and_reports(spark, workdir):
    lines = _lines(spark)
    t = f"t_{uuid.uuid4().hex[:8]}"
    cfg = ExtractionConfig(table=t, entity_name="E", location=f"{workdir}/{t}", batch_size=64, catalog="cat", warehouse="s3a://w",
                           as_of="2025-05-01", as_of_ts="2025-05-01 00:00:00")
    run = run_extraction(spark, lines, cfg)
    res = run.result.first()
    assert res["total_file_refs_identified"] == res["total_records_written"] == 200
    assert (res["in_network_count"], res["allowed_amount_count"], res["other_count"]) == (68, 66, 66)
    assert len(res["sample_urls"]) == 15
    assert res["sample_urls"][0] == res["sample_urls"][1] == "https://example.com/in-network/file0.json.gz"
    c = classified_refs(lines)
    rec = reconcile(c, table_rows(spark, t)).first()
    assert (rec["identified"], rec["written"], rec["lost"]) == (200, 200, 0)
    lost = reconcile(c, table_rows(spark, t).limit(150)).first()
    assert lost["lost"] == 50
    text = [r["text"] for r in run.summary(cfg, "now").orderBy("line_no").collect()]
    assert {"References identified: 200", "Batches: 4", "Catalog: cat", "Warehouse: s3a://w", f"Table: {t}"} <= set(text)
    assert text[-1] == "- https://example.com/in-network/file9.json.gz"
    details = [r["text"] for r in run.details(cfg, "now").orderBy("line_no").collect()]
    assert "In-network: 68 (34.00 %)" in details and details[-1].startswith("Columns: reporting_entity_name, ")


def test_job_caches_nothing_and_writes_without_numbers(spark, workdir):
    import inspect

    import linkyard.plans.job as job

    assert "persist" not in inspect.getsource(job)
    path = write_text(f"{workdir}/nc/index.json.gz", x1_lines(), gz=True)
    from linkyard.sources import read_lines_raw

    plan = file_refs(read_lines_raw(spark, path), "E")._jdf.queryExecution().executedPlan().toString()
    assert "line_no" not in plan and "Window" not in plan and "Aggregate" not in plan and "Join" not in plan


def test_whole_job_over_gzip_index(spark, workdir):
    path = write_text(f"{workdir}/in/index.json.gz", x1_lines(), gz=True)
    cfg = ExtractionConfig(table=f"job_{uuid.uuid4().hex[:8]}", entity_name="E", location=f"{workdir}/job",
                           as_of="2025-05-01", as_of_ts="2025-05-01 00:00:00", batch_size=64)
    run = extract_index_file(spark, path, cfg)
    r = run.result.first()
    assert run.counters["written"] == 200 and run.batch_count == 4
    assert (r["in_network_count"], r["allowed_amount_count"], r["other_count"]) == (68, 66, 66)
    assert len(r["sample_urls"]) == 15
    assert run.sample.count() == 20
    out = write_summary(run, cfg, f"{workdir}/summary", "2025-05-01 00:00:00")
    parts = [p for p in os.listdir(out) if p.startswith("part-")]
    assert len(parts) == 1
    # Capped run: only the first 10 references.
    capped = ExtractionConfig(table=f"cap_{uuid.uuid4().hex[:8]}", entity_name="E", location=f"{workdir}/cap",
                              max_records=10, as_of="2025-05-01", as_of_ts="2025-05-01 00:00:00")
    run2 = run_extraction(spark, _lines(spark), capped)
    assert run2.counters["written"] == 10


def test_command_line_job(spark, workdir):
    from linkyard.plans.cli import parse_args, run

    path = write_text(f"{workdir}/cli/index.json.gz", x1_lines(), gz=True)
    db = f"db_{uuid.uuid4().hex[:6]}"
    args = parse_args(["--index-file", "file://" + path, "--warehouse-location", f"{workdir}/wh",
                       "--catalog-name", db, "--file-refs-table", f"cli_{uuid.uuid4().hex[:6]}",
                       "--batch-size", "64", "--entity-name", "E", "--summary-path", f"{workdir}/cli-summary"])
    out = run(spark, args)
    assert out["total_file_refs_identified"] == 200 and out["batch_count"] == 4
    assert out["table"].startswith(db + ".") and spark.table(out["table"]).count() == 200
    assert out["elapsed"].endswith("s")
    src = f"{workdir}/cli-stream"
    write_text(f"{src}/a.json.gz", x1_lines(), gz=True)
    sargs = parse_args(["--index-file", src, "--file-refs-table", f"clis_{uuid.uuid4().hex[:6]}",
                        "--warehouse-location", f"{workdir}/wh2", "--entity-name", "E", "--stream",
                        "--progress-interval", "0", "--checkpoint", f"{workdir}/cli-ckpt"])
    sout = run(spark, sargs)
    assert sum(b["records_written"] for b in sout["batches"]) == sout["totals"]["refs"] == 200


def test_stream_report_has_every_batch_and_a_restart_adds_none(spark, workdir):
    from linkyard.plans.cli import parse_args, run

    src, table = f"{workdir}/cli5", f"cli5_{uuid.uuid4().hex[:6]}"
    for i in range(5):
        write_text(f"{src}/f{i}.txt", [f"https://a/{i} https://b/{i}"])
    argv = ["--index-file", src, "--file-refs-table", table, "--warehouse-location", f"{workdir}/wh5", "--entity-name", "E",
            "--stream", "--progress-interval", "0", "--max-files-per-trigger", "1"]
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")
    try:
        out = run(spark, parse_args(argv))
        again = run(spark, parse_args(argv))  # no --checkpoint: the same one is found again
    finally:
        spark.conf.unset(key)
    assert [b["records_written"] for b in out["batches"]] == [2] * 5
    assert out["totals"]["batches"] == 5 and out["totals"]["refs"] == 10
    assert again["checkpoint"] == out["checkpoint"] and again["batches"] == out["batches"]
    assert spark.read.parquet(f"{workdir}/wh5/{table}").count() == 10


def test_stream_refuses_flags_it_cannot_honour(spark):
    import pytest

    from linkyard.plans.cli import parse_args

    base = ["--index-file", "x", "--entity-name", "E", "--stream"]
    for more in (["--max-records", "3"], ["--mode", "replace_date"], ["--batch-size", "7"], ["--summary-path", "s"]):
        with pytest.raises(SystemExit):
            parse_args(base + more)


def test_records_per_file_caps_output_files(spark, workdir):
    t = _table(spark, workdir)
    refs = file_refs(_lines(spark).coalesce(1), "E", "payer", "2025-05-01", "2025-05-01 00:00:00")
    write_refs(refs, t, records_per_file=50)
    part_dir = f"{workdir}/{t}/file_date=2025-05-01"
    files = [f for f in os.listdir(part_dir) if f.endswith(".parquet")]
    assert len(files) == 4
    assert spark.conf.get("spark.sql.files.maxRecordsPerFile") in ("0", None)
    assert spark.table(t).count() == 200


def test_batch_runs_report_their_stages(spark, workdir):
    import time

    from linkyard.plans.progress import reported

    seen = []
    with reported(spark, 0.2, seen.append):
        spark.range(4).repartition(2).rdd.map(lambda r: time.sleep(0.8) or r).count()
    assert len(seen) >= 2 and [r["elapsed_s"] for r in seen] == sorted(r["elapsed_s"] for r in seen)
    stages = [s for r in seen for s in r["stages"]]
    assert stages and all(0 <= s["done"] <= s["tasks"] for s in stages)
    with reported(spark, 0, seen.append):
        n = len(seen)
    assert len(seen) == n
