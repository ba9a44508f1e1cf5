"""Streaming ingest: stream = batch, no file read twice, progress, table sink."""

from __future__ import annotations

import uuid

from linkyard.operators import file_refs
from linkyard.sinks import ensure_table
from linkyard.sources import read_lines
from linkyard.streaming import committed_batches, progress_rows, stream_file_refs, stream_into_table, write_stream_batch

from .fixtures import write_text, x1_lines

TS = ("2025-05-01", "2025-05-01 00:00:00")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_and_restart_reads_nothing_twice(spark, workdir):
    src = f"{workdir}/src"
    for k in range(3):
        write_text(f"{src}/part{k}.json.gz", x1_lines()[k * 34:(k + 1) * 34], gz=True)
    sink, ckpt = f"{workdir}/sink", f"{workdir}/ckpt"
    q = stream_file_refs(spark, src, sink, ckpt, "E", "payer", *TS, max_files_per_trigger=1)
    q.awaitTermination()
    streamed = spark.read.parquet(sink).select(*file_refs(read_lines(spark, src), "E", "payer", *TS).columns)
    batch = file_refs(read_lines(spark, src), "E", "payer", *TS)
    assert _rows(streamed) == _rows(batch)
    prog = [p for p in progress_rows(q) if p["input_rows"] > 0]
    assert len(prog) == 3 and sum(p["refs"] for p in prog) == 200
    assert sum(p["in_network_count"] for p in prog) == 68
    # Restart with the same checkpoint: nothing new, nothing re-read.
    q2 = stream_file_refs(spark, src, sink, ckpt, "E", "payer", *TS)
    q2.awaitTermination()
    assert spark.read.parquet(sink).count() == 200
    # A new file is picked up alone.
    write_text(f"{src}/part9.json.gz", ['{"url": "https://n/in-network/z.json"}'], gz=True)
    q3 = stream_file_refs(spark, src, sink, ckpt, "E", "payer", *TS)
    q3.awaitTermination()
    assert spark.read.parquet(sink).count() == 202


def test_a_batch_that_comes_again_is_not_doubled(spark, workdir):
    """The batch function, called again with one id: after the mark, and after a crash before it."""
    import shutil

    table, ckpt = f"st_{uuid.uuid4().hex[:8]}", f"{workdir}/ckpt2"
    ensure_table(spark, table, location=f"{workdir}/{table}")
    lines = spark.createDataFrame(list(enumerate(x1_lines())), "line_no long, value string")
    one, two = (file_refs(lines.where(f"line_no % 2 = {k}"), "E", "payer", *TS) for k in (0, 1))

    def stored():
        return spark.read.parquet(f"{workdir}/{table}").count()  # the files, whatever a session has cached

    assert write_stream_batch(one, 0, table, ckpt) == one.count()
    assert write_stream_batch(two, 1, table, ckpt) == two.count()
    assert stored() == 200
    assert write_stream_batch(two, 1, table, ckpt) is None
    assert stored() == 200
    shutil.rmtree(f"{ckpt}/linkyard_batches_done/1")  # the crash: files are in the table, the mark is not
    assert write_stream_batch(two, 1, table, ckpt) == two.count()
    assert stored() == 200
    spark.catalog.refreshTable(table)
    assert _rows(spark.table(table)) == _rows(file_refs(lines, "E", "payer", *TS).select(*spark.table(table).columns))
    assert sorted(r["batch_id"] for r in committed_batches(spark, ckpt).collect()) == [0, 1]


def test_stream_into_table_restart_and_callers_view(spark, workdir):
    src = f"{workdir}/src2"
    write_text(f"{src}/a.json.gz", x1_lines(), gz=True)
    table = f"st_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, table, location=f"{workdir}/{table}")
    ckpt = f"{workdir}/ckpt3t"
    assert spark.table(table).count() == 0  # the caller has listed the empty table
    stream_into_table(spark, src, table, ckpt, "E", "payer", *TS).awaitTermination()
    assert spark.table(table).count() == 200
    write_text(f"{src}/b.json.gz", x1_lines(), gz=True)
    stream_into_table(spark, src, table, ckpt, "E", "payer", *TS).awaitTermination()
    assert spark.table(table).count() == 400 == spark.read.parquet(f"{workdir}/{table}").count()


def test_progress_recorder_keeps_every_batch(spark, workdir):
    from linkyard.streaming import ProgressRecorder

    src = f"{workdir}/src3"
    for k in range(5):
        write_text(f"{src}/p{k}.json.gz", x1_lines()[k * 20:(k + 1) * 20], gz=True)
    rec = ProgressRecorder(every=2)
    spark.streams.addListener(rec)
    try:
        q = stream_file_refs(spark, src, f"{workdir}/sink3", f"{workdir}/ckpt3", "E", "payer", *TS,
                             max_files_per_trigger=1)
        q.awaitTermination()
        import time

        for _ in range(50):  # listener events arrive asynchronously
            if sum(r["input_rows"] for r in rec.for_query(q)) >= 100:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(rec)
    rows = [r for r in rec.for_query(q) if r["input_rows"] > 0]
    assert len(rows) == 5 and sum(r["refs"] for r in rows) == 198  # lines 0-99: header + 99 URL lines x 2
    assert all(r["batch_id"] % 2 == 0 for r in rec.reports)
    assert rec.totals[str(q.id)]["refs"] == 198 and rec.totals[str(q.id)]["batches"] == 5


def test_stream_caps_rows_per_file(spark, workdir):
    import os

    src = f"{workdir}/src4"
    write_text(f"{src}/a.json.gz", x1_lines(), gz=True)
    sink = f"{workdir}/sink4"
    q = stream_file_refs(spark, src, sink, f"{workdir}/ckpt4", "E", "payer", *TS, max_records_per_file=30)
    q.awaitTermination()
    part = f"{sink}/file_date=2025-05-01"
    files = [f for f in os.listdir(part) if f.endswith(".parquet")]
    assert len(files) >= 200 // 30 and spark.read.parquet(sink).count() == 200


def test_readers_see_whole_batches_only(spark, workdir, monkeypatch):
    """Batches of several dates and many files: every read, at each step of publishing and from a thread all
    the time, gives the rows of whole batches; no file moves."""
    import threading

    from pyspark.sql import functions as F

    from linkyard.sinks import ensure_stream_table, tables, write_refs

    table = f"sw_{uuid.uuid4().hex[:8]}"
    ensure_stream_table(spark, table, location=f"{workdir}/{table}")
    lines = spark.createDataFrame(list(enumerate(x1_lines() * 3)), "line_no long, value string").repartition(6)
    batches = [file_refs(lines.where(f"line_no % 3 = {k}"), "E", "payer", *TS).withColumn(
        "file_date", F.expr("date_add(file_date, cast(length(file_url) % 4 as int))")) for k in range(3)]
    sizes = [b.count() for b in batches]
    allowed = {sum(sizes[:k]) for k in range(4)}
    seen, stop = set(), threading.Event()

    def read_on():
        while not stop.is_set():
            seen.add(spark.table(table).count())

    steps = []
    publish = tables.publish_batch

    def watched(*a):
        steps.append(spark.table(table).count())
        publish(*a)
        steps.append(spark.table(table).count())
    monkeypatch.setattr("linkyard.streaming.ingest.publish_batch", watched)
    reader = threading.Thread(target=read_on)
    reader.start()
    try:
        for k, b in enumerate(batches):
            assert write_stream_batch(b, k, table, f"{workdir}/ckpt_sw") == sizes[k]
    finally:
        stop.set()
        reader.join()
    assert seen <= allowed and steps == [x for k in range(3) for x in (sum(sizes[:k]), sum(sizes[:k + 1]))]
    assert spark.table(table).columns == batches[0].columns
    # A replay after the partitions were added but before the mark was written changes nothing.
    import shutil

    shutil.rmtree(f"{workdir}/ckpt_sw/linkyard_batches_done/2")
    assert write_stream_batch(batches[2], 2, table, f"{workdir}/ckpt_sw") == sizes[2]
    assert spark.table(table).count() == sum(sizes)
    # A batch run is one more batch of such a table; an empty batch adds nothing.
    assert write_refs(batches[0], table).records_written == sizes[0]
    assert write_stream_batch(batches[0].where("false"), 7, table, f"{workdir}/ckpt_sw") == 0
    assert spark.table(table).count() == sum(sizes) + sizes[0]
    assert _rows(spark.table(table)) == _rows(batches[0].union(batches[0]).union(batches[1]).union(batches[2]))


def test_lost_files_show_in_the_reconciliation(spark, workdir):
    import os
    from glob import glob

    from linkyard.operators import reconcile_files
    from linkyard.sinks import committed_files, write_refs

    table = f"rl_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, table, location=f"{workdir}/{table}")
    lines = spark.createDataFrame(list(enumerate(x1_lines())), "line_no long, value string").repartition(4)
    report = write_refs(file_refs(lines, "E", "payer", *TS), table)
    whole = reconcile_files(report.records_written, committed_files(spark, table)).first()
    assert (whole["identified"], whole["written"], whole["lost"]) == (200, 200, 0)
    victim = sorted(glob(f"{workdir}/{table}/file_date=*/*.parquet"))[0]
    n = spark.read.parquet(victim).count()
    os.remove(victim)
    spark.catalog.refreshTable(table)
    after = reconcile_files(report.records_written, committed_files(spark, table, TS[0])).first()
    assert (after["written"], after["lost"]) == (200 - n, n) and n > 0
