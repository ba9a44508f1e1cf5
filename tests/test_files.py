"""References of text files by path and place: index, caps and samples that open no more than they need."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from linkyard.operators import assign_batches, cap_records, extract_refs, filter_http, first_refs_of_lines, indexed_refs, with_ordinal
from linkyard.operators.files import cap_file_refs, first_file_refs, path_groups
from linkyard.plans import ExtractionConfig, extract_index_file
from linkyard.sources import read_lines_ordered

from .fixtures import write_text


def some_files(root, n_files=12, gz=True):
    """Files with 0 to 4 references a line, names that need escaping, an empty file; returns their lines by path."""
    lines = {}
    for k in range(n_files):
        body = []
        for i in range(0 if k == 4 else 40 + 7 * k):
            urls = [f"https://h.com/{'in-network' if (i + j) % 3 else 'x'}/{k}-{i}-{j}.json" for j in range((i + k) % 5)]
            body.append(" see ".join(f'{{"url": "{u}"}},' if j % 2 else u for j, u in enumerate(urls)) or f"plain {k} {i}")
        path = f"{root}/in dex {k:02d}%.json" + (".gz" if gz else "")
        write_text(path, body, gz=gz)
        lines[path] = body
    return lines


def expected(spark, lines):
    """References in order, each line by itself through the operator over single numbered lines."""
    flat = [(i, v) for i, v in enumerate(v for p in sorted(lines) for v in lines[p])]
    df = spark.createDataFrame(flat, "line_no long, value string")
    return [r["file_url"] for r in filter_http(extract_refs(df)).orderBy("line_no", "pos").collect()]


@pytest.mark.parametrize("gz", [True, False])
def test_index_runs_over_all_files(spark, workdir, gz):
    want = expected(spark, some_files(f"{workdir}/a", gz=gz))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")  # many splits a file, several files a partition
    try:
        got = indexed_refs(read_lines_ordered(spark, f"{workdir}/a")).orderBy("ref_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["ref_index"] for r in got] == list(range(len(want)))
    assert [r["file_url"] for r in got] == want


def test_index_over_ranges_of_paths(spark, workdir, monkeypatch):
    from linkyard.operators import ordering

    want = expected(spark, some_files(f"{workdir}/b"))
    monkeypatch.setattr(ordering, "_path_bounds", lambda df: sorted(r[0] for r in df.select("file_path").distinct().collect())[2::3])
    got = indexed_refs(read_lines_ordered(spark, f"{workdir}/b")).orderBy("ref_index").collect()
    assert [r["file_url"] for r in got] == want and [r["ref_index"] for r in got] == list(range(len(want)))


def test_no_text_is_shuffled(spark, workdir):
    some_files(f"{workdir}/c")
    batches = assign_batches(read_lines_ordered(spark, f"{workdir}/c"), 100)
    batches.collect()
    plan = batches._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    assert moved and not any("file_url" in line or "value" in line for line in moved)
    for block in plan.split("Exchange hashpartitioning")[1:]:
        assert "file_url#" not in block.split("\n")[0]


def test_one_scan_for_ordered_numbers(spark, workdir):
    lines = some_files(f"{workdir}/d", gz=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    try:
        numbered = with_ordinal(read_lines_ordered(spark, f"{workdir}/d"), ["file_path", "split", "record"], "n").select("n", "value")
        rows = numbered.orderBy("n").collect()
        numbered.collect()
        plan = numbered._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r["n"], r["value"]) for r in rows] == list(enumerate(v for p in sorted(lines) for v in lines[p]))
    assert plan.count("FileScan text") == 1 and "ReusedExchange" in plan


def test_cap_opens_only_the_files_it_needs(spark, workdir):
    """Files behind the first three are no gzip at all: opening one would fail."""
    root = f"{workdir}/e"
    lines = some_files(root, 3)
    want = expected(spark, lines)
    for k in range(97):
        with open(f"{root}/zz{k:03d}.json.gz", "wb") as f:
            f.write(b"not a gzip file")
    assert [last.rsplit("/", 1)[1][:2] for last, _ in path_groups(spark, root)][:3] == ["in", "in", "zz"]
    for cap in (1, 10, len(want) - 1, len(want)):
        got = cap_file_refs(spark, root, cap).orderBy("file_path", "split", "record", "pos").collect()
        assert [r["file_url"] for r in got] == want[:cap]
    assert [r["file_url"] for r in first_file_refs(spark, root, 20).orderBy("sample_rank").collect()] == want[:20]


@pytest.mark.parametrize("form", ["{}", "file://{}", "file:{}", "{}/*"])
def test_paths_in_any_form(spark, workdir, form):
    want = expected(spark, some_files(f"{workdir}/forms", 3))
    path = form.format(f"{workdir}/forms")
    got = cap_file_refs(spark, path, 30).orderBy("file_path", "split", "record", "pos")
    assert [r["file_url"] for r in got.collect()] == want[:30]
    assert [r["file_url"] for r in first_file_refs(spark, path, 9).orderBy("sample_rank").collect()] == want[:9]


def test_cap_beyond_all_and_none(spark, workdir):
    want = expected(spark, some_files(f"{workdir}/f", 5))
    got = cap_file_refs(spark, f"{workdir}/f", 10**6).orderBy("file_path", "split", "record", "pos")
    assert [r["file_url"] for r in got.collect()] == want
    assert cap_file_refs(spark, f"{workdir}/f", 0).count() == len(want)


@pytest.mark.parametrize("cap", [1, 7, 60, 500, 10**6])
def test_cap_of_keyed_lines_equals_the_full_index(spark, cap):
    rows = [(i * 5 - 900, " ".join(f"http://a/{i}/{j}" for j in range(i % 4))) for i in range(400)]
    lines = spark.createDataFrame(rows, "line_no long, value string").repartition(5)
    whole = indexed_refs(lines).where(F.col("ref_index") < cap).drop("ref_index")
    assert sorted(map(tuple, cap_records(lines, cap).collect())) == sorted(map(tuple, whole.collect()))


class Counted:
    """Counts the rows that DataFrames bring to the driver."""

    def __init__(self, monkeypatch):
        from pyspark.sql.classic.dataframe import DataFrame

        self.rows, collect = 0, DataFrame.collect

        def counting(frame):
            out = collect(frame)
            self.rows += len(out)
            return out
        monkeypatch.setattr(DataFrame, "collect", counting)


def test_sample_of_escaped_urls_brings_nothing_to_the_driver(spark, workdir, monkeypatch):
    """20 000 lines that hold the marker but no reference, over several files: 0 rows; then one reference at the very end."""
    root = f"{workdir}/g"
    for k in range(5):
        write_text(f"{root}/i{k}.json.gz", [r'{"url": "http' + rf's:\/\/h.com\/{k}-{i}.json"}},' for i in range(4000)], gz=True)
    seen = Counted(monkeypatch)
    assert first_file_refs(spark, root, 20)._jdf.count() == 0
    assert seen.rows == 0
    write_text(f"{root}/z.json.gz", ["https://h.com/last.json"] * 30, gz=True)
    assert first_file_refs(spark, root, 20)._jdf.count() == 20
    assert seen.rows == 20


def test_sample_of_a_one_line_index_moves_references_only(spark, workdir, monkeypatch):
    os.makedirs(f"{workdir}/h")
    with gzip.open(f"{workdir}/h/one.json.gz", "wt") as f:
        f.write(" ".join(f'{{"url": "https://h.com/in-network/{i}.json"}},' for i in range(30_000)))
    seen = Counted(monkeypatch)
    got = first_file_refs(spark, f"{workdir}/h", 20)
    assert seen.rows == 20 and got.columns == ["file_path", "split", "record", "pos", "file_url", "sample_rank"]


def test_sample_of_keyed_lines_is_bounded(spark, monkeypatch):
    rows = [(i, "http" + r"s:\/\/h.com" if i < 5000 else f"https://h.com/{i}") for i in range(5100)]
    lines = spark.createDataFrame(rows, "line_no long, value string").repartition(4)
    seen = Counted(monkeypatch)
    got = first_refs_of_lines(lines, 20)
    assert seen.rows <= 120
    assert [r["line_no"] for r in got.orderBy("sample_rank").collect()] == list(range(5000, 5020))
    seen.rows = 0
    assert [r["line_no"] for r in first_refs_of_lines(lines.where("line_no >= 5000"), 5).orderBy("sample_rank").collect()] == list(range(5000, 5005))
    assert seen.rows <= 120


def test_capped_job_over_files(spark, workdir):
    lines = some_files(f"{workdir}/i", 6)
    want = expected(spark, lines)
    for cap in (0, 3, 50):
        cfg = ExtractionConfig(table=f"capped_{cap}_{os.path.basename(workdir).replace('-', '_')}", entity_name="E", max_records=cap,
                               location=f"{workdir}/t{cap}", as_of="2025-05-01", as_of_ts="2025-05-01 00:00:00")
        run = extract_index_file(spark, f"{workdir}/i", cfg)
        kept = want[:cap] if cap else want
        row = run.result.collect()[0]
        assert row["total_records_written"] == len(kept) and list(row["sample_urls"]) == kept[:15]
        assert sorted(r["file_url"] for r in spark.table(cfg.table).collect()) == sorted(kept)
