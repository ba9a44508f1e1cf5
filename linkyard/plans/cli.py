"""Command-line job: ``python -m linkyard.plans.cli --index-file ... [--stream]``
(under spark-submit, a two-line driver script calling ``main()``).

The same seven parameters as a containerised extraction run, plus the run
mode.  Batch mode runs the whole job once (extract, write, result, summary), reporting the running
stages every ``--progress-interval`` seconds;
``--stream`` ingests new files of a folder with Structured Streaming,
``--progress-interval`` seconds per micro-batch (0 = process what is there
and stop).
"""

from __future__ import annotations

import argparse
import hashlib
import json
import time

from pyspark.sql import SparkSession

from ..functions.patterns import DEFAULT_BATCH_SIZE, DEFAULT_ENTITY_TYPE
from ..session import stable_checkpoint_root
from ..sinks import ensure_stream_table, table_exists
from ..streaming.ingest import ProgressRecorder, committed_batches, stream_into_table
from .job import ExtractionConfig, extract_index_file, write_details, write_summary
from .progress import reported


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="linkyard", description=__doc__)
    # The names of the seven run parameters.
    p.add_argument("--index-file", required=True, help="file or folder, any Hadoop scheme (s3a://, hdfs://, file://)")
    p.add_argument("--warehouse-location", default=None, help="table root on shared storage (parquet tables)")
    p.add_argument("--catalog-name", default=None, help="catalog/database of the table")
    p.add_argument("--file-refs-table", default="file_refs")
    p.add_argument("--batch-size", type=int, default=DEFAULT_BATCH_SIZE,
                   help="write batch size: batch count in the result (one atomic write per run)")
    p.add_argument("--max-records", type=int, default=0,
                   help="first N references in file order, 0 = all (batch mode; a stream has no global order)")
    p.add_argument("--records-per-file", type=int, default=None,
                   help="cap rows per output file (file-level write batches); unset for large runs")
    p.add_argument("--progress-interval", type=int, default=30, help="seconds between progress reports; with --stream also per micro-batch (0: none, and a stream stops when all is read)")
    p.add_argument("--entity-name", required=True)
    p.add_argument("--entity-type", default=DEFAULT_ENTITY_TYPE)
    p.add_argument("--provider", default="parquet", help="parquet, or iceberg when its runtime is present")
    p.add_argument("--mode", default="append", choices=["append", "replace_date"])
    p.add_argument("--line-sep", default=None, help='e.g. "}," for an index written on one line')
    p.add_argument("--summary-path", default=None, help="where to write the summary text")
    p.add_argument("--details-path", default=None, help="where to write the detailed report")
    p.add_argument("--spread", choices=["auto", "always", "never"], default="auto",
                   help="hash-spread lines before the regex (always: a few huge .gz files among many)")
    p.add_argument("--stream", action="store_true")
    p.add_argument("--checkpoint", default=None, help="stream checkpoint (default: one per source and table under spark.checkpoint.dir)")
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    args = p.parse_args(argv)
    if args.stream:
        # What a stream cannot do is refused, not ignored.
        for flag, wrong in (("--max-records", args.max_records > 0), ("--mode replace_date", args.mode != "append"),
                            ("--batch-size", args.batch_size != DEFAULT_BATCH_SIZE), ("--summary-path", args.summary_path),
                            ("--details-path", args.details_path)):
            if wrong:
                p.error(f"{flag} has no meaning with --stream")
    return args


def _stream_checkpoint(spark: SparkSession, table: str, source: str) -> str:
    """The same folder for every run over this source and table, so a restart goes on where it stopped."""
    name = hashlib.sha1(f"{table}|{source.rstrip('/')}".encode()).hexdigest()[:16]
    return f"{stable_checkpoint_root(spark)}/linkyard-streams/{name}"


def _table_name(args: argparse.Namespace) -> str:
    return f"{args.catalog_name}.{args.file_refs_table}" if args.catalog_name else args.file_refs_table


def _wait_for_reports(recorder: ProgressRecorder, query, seconds: float = 10.0) -> None:
    """Listener events arrive a little after the query has ended: wait for its last one."""
    last, until = query.lastProgress, time.time() + seconds
    while last is not None and time.time() < until:
        rows = recorder.for_query(query)
        if rows and rows[-1]["batch_id"] >= int(last.batchId):
            return
        time.sleep(0.05)


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    table = _table_name(args)
    location = f"{args.warehouse_location.rstrip('/')}/{args.file_refs_table}" if args.warehouse_location else None
    cfg = ExtractionConfig(table=table, entity_name=args.entity_name, entity_type=args.entity_type,
                           batch_size=args.batch_size, max_records=args.max_records, mode=args.mode,
                           provider=args.provider, location=location, records_per_file=args.records_per_file,
                           catalog=args.catalog_name, warehouse=args.warehouse_location)
    if args.catalog_name and args.provider == "parquet":
        # Session catalog: the "catalog" is a database; create it on first use.
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {args.catalog_name}")
    start = time.time()
    spread = {"auto": None, "always": True, "never": False}[args.spread]
    if args.stream:
        if not table_exists(spark, table):  # a table of its own takes whole batches; one that is there is used as it is
            ensure_stream_table(spark, table, args.provider, location)
        ckpt = args.checkpoint or _stream_checkpoint(spark, table, args.index_file)
        recorder = ProgressRecorder(on_report=lambda row: print(json.dumps({"progress": row}), flush=True))
        spark.streams.addListener(recorder)
        q = stream_into_table(spark, args.index_file, table, ckpt, args.entity_name, args.entity_type,
                              max_files_per_trigger=args.max_files_per_trigger,
                              available_now=args.progress_interval <= 0,
                              processing_time=(f"{args.progress_interval} seconds"
                                               if args.progress_interval > 0 else None),
                              line_sep=args.line_sep, records_per_file=args.records_per_file, spread=spread)
        try:
            q.awaitTermination()
            _wait_for_reports(recorder, q)
        finally:
            spark.streams.removeListener(recorder)
        batches = committed_batches(spark, ckpt).orderBy("batch_id")
        out = {"table": table, "checkpoint": ckpt, "totals": recorder.totals.get(str(q.id), {}),
               "batches": [r.asDict() for r in batches.toLocalIterator()]}
    else:
        with reported(spark, args.progress_interval, lambda row: print(json.dumps({"progress": row}), flush=True)):
            job = extract_index_file(spark, args.index_file, cfg, line_sep=args.line_sep, spread=spread)
        row = job.result.first().asDict()
        out = {"table": table, "batch_count": job.batch_count, **row}
        if args.summary_path:
            write_summary(job, cfg, args.summary_path, time.strftime("%Y-%m-%d %H:%M:%S"))
        if args.details_path:
            write_details(job, cfg, args.details_path, time.strftime("%Y-%m-%d %H:%M:%S"))
    elapsed = time.time() - start
    out["elapsed_s"] = round(elapsed, 3)
    out["elapsed"] = f"{int(elapsed // 3600)}h {int(elapsed % 3600 // 60)}m {int(elapsed % 60)}s"
    return out


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("linkyard").getOrCreate()
    print(json.dumps(run(spark, args), default=str))


if __name__ == "__main__":
    main()
