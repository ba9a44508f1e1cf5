"""Run by test_resilience.py in its own process: tasks of the scan stage fail on
their first attempt; the retried tasks must give exactly the same numbered
lines, global index and batches as plain Python."""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from linkyard.operators import assign_batches  # noqa: E402
from linkyard.sources import read_lines  # noqa: E402
from tests.fixtures import scan_refs, write_text  # noqa: E402


def flaky(batches):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 1:
        raise RuntimeError("injected failure on first attempt")
    yield from batches


def main() -> None:
    spark = (SparkSession.builder.master("local[4,4]").appName("resilience")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "6")
             .config("spark.sql.files.maxPartitionBytes", "32k").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    d = tempfile.mkdtemp(prefix="linkyard-resilience-")
    lines = [f'{{"url": "https://h/{i}.csv"}} https://x/{i}' if i % 5 else f"plain {i}" for i in range(6000)]
    write_text(f"{d}/in/a.txt", lines)
    write_text(f"{d}/in/b.txt.gz", lines[:700], gz=True)
    numbered = read_lines(spark, f"{d}/in", spread=False)
    shaky = numbered.mapInPandas(flaky, numbered.schema)
    got = sorted((os.path.basename(r["file_path"]), r["line_no"], r["pos"], r["file_url"], r["ref_index"], r["batch_no"])
                 for r in assign_batches(shaky, 1000).collect())
    want, idx = [], 0
    for name, content in (("a.txt", lines), ("b.txt.gz", lines[:700])):
        for n, text in enumerate(content):
            for p, u in enumerate(scan_refs(text)):
                want.append((name, n, p, u, idx, idx // 1000 + 1))
                idx += 1
    assert numbered.rdd.getNumPartitions() > 4, "input must be split"
    assert got == sorted(want), "results differ after task retries"
    # Gzip only: one file per partition, numbered in one pass.
    for k in range(3):
        write_text(f"{d}/gz/p{k}.txt.gz", lines[k * 1000:(k + 1) * 1000 + 500], gz=True)
    gz = read_lines(spark, f"{d}/gz", spread=False)
    shaky_gz = gz.mapInPandas(flaky, gz.schema)
    got_gz = sorted((os.path.basename(r["file_path"]), r["line_no"], r["value"]) for r in shaky_gz.collect())
    want_gz = sorted((f"p{k}.txt.gz", i, v) for k in range(3)
                     for i, v in enumerate(lines[k * 1000:(k + 1) * 1000 + 500]))
    assert got_gz == want_gz, "gzip line numbers differ after task retries"
    print("RESILIENCE-OK", len(got))
    spark.stop()


if __name__ == "__main__":
    main()
