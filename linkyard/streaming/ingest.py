"""Incremental ingest of index files with Structured Streaming (T1-T4).

``readStream.text(dir)`` -> the same extract/classify projection as the batch
job -> a sink.  New files are picked up once each (the file source tracks
them in the checkpoint), ``maxFilesPerTrigger`` sizes micro-batches, and
``df.observe`` publishes per-batch counters in ``query.recentProgress``.

Sinks:
* ``stream_file_refs``: Parquet file sink partitioned by ``file_date``;
  exactly-once through the sink's ``_spark_metadata`` log.
* ``stream_into_table``: ``foreachBatch`` into the catalog table.  ``foreachBatch`` is
  at-least-once, so a batch is written to a folder of its own, named after checkpoint and batch id and replaced if the
  batch comes again before it is published.  Into a table of ``ensure_stream_table`` it is published by adding its
  partitions to the catalog in one statement: readers see all of it or nothing, no file is renamed, and a
  published batch is not written twice.  Into a plain Parquet table its files are renamed one by one, under names that
  a replay replaces (readers may see a part meanwhile).  A mark per batch, looked up by its path, ends it.  (Never
  combine this with ``replace_date``: a later batch of the same date would replace the earlier one.)
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import deque

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.patterns import ALLOWED_AMOUNT, DEFAULT_ENTITY_TYPE, IN_NETWORK, OTHER
from ..operators.refs import classified_refs, to_file_refs
from ..schema import FILE_REFS_COLUMNS, PARTITION_COLUMN
from ..sinks.tables import (
    batches_name, is_v2, publish_batch, published_batch, session_conf, table_location, takes_batches, write_batch_files, write_refs,
)
from ..sources.inventory import object_exists
from ..sources.lines import read_lines_stream

PROGRESS_NAME = "linkyard_progress"


def streaming_file_refs(
    spark: SparkSession,
    src_dir: str,
    entity_name: str,
    entity_type: str = DEFAULT_ENTITY_TYPE,
    as_of: str | dt.date | None = None,
    as_of_ts: str | dt.datetime | None = None,
    max_files_per_trigger: int | None = None,
    line_sep: str | None = None,
    observe: bool = True,
    spread: bool | None = None,
) -> DataFrame:
    """The streaming DataFrame of 10-column file refs (no sink yet)."""
    lines = read_lines_stream(spark, src_dir, max_files_per_trigger, line_sep, spread)
    classified = classified_refs(lines)
    if observe:
        net = F.col("file_network")
        classified = classified.observe(
            PROGRESS_NAME,
            F.count(F.lit(1)).alias("refs"),
            F.count_if(net == IN_NETWORK).alias("in_network_count"),
            F.count_if(net == ALLOWED_AMOUNT).alias("allowed_amount_count"),
            F.count_if(net == OTHER).alias("other_count"),
        )
    return to_file_refs(classified, entity_name, entity_type, as_of, as_of_ts)


def stream_file_refs(
    spark: SparkSession,
    src_dir: str,
    sink_path: str,
    checkpoint: str,
    entity_name: str,
    entity_type: str = DEFAULT_ENTITY_TYPE,
    as_of: str | dt.date | None = None,
    as_of_ts: str | dt.datetime | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_records_per_file: int | None = None,
    line_sep: str | None = None,
) -> StreamingQuery:
    """T1: start the file-sink stream; returns the running query.

    ``available_now`` processes what is there and stops (a scheduled run);
    otherwise ``processing_time`` (e.g. ``"30 seconds"``) keeps it running.
    """
    df = streaming_file_refs(spark, src_dir, entity_name, entity_type, as_of, as_of_ts,
                             max_files_per_trigger, line_sep)
    w = (df.writeStream.format("parquet").partitionBy(PARTITION_COLUMN)
         .option("path", sink_path).option("checkpointLocation", checkpoint).outputMode("append"))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def _batch_mark(checkpoint: str, batch_id: int) -> str:
    return f"{checkpoint.rstrip('/')}/linkyard_batches_done/{int(batch_id)}"


def _publish(spark: SparkSession, staged: str, table: str, stem: str) -> None:
    """Move a staged batch's files into the table's partitions under names that begin with ``stem``;
    files of an earlier try of the batch go first."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hpath(table_location(spark, table))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for old in fs.globStatus(hpath(root, f"{PARTITION_COLUMN}=*/{stem}-*")) or []:
        fs.delete(old.getPath(), False)
    dates = set()
    for n, part in enumerate(sorted(fs.globStatus(hpath(f"{staged}/{PARTITION_COLUMN}=*/part-*")) or [], key=lambda x: x.getPath().toString())):
        folder = hpath(root, part.getPath().getParent().getName())
        fs.mkdirs(folder)
        if not fs.rename(part.getPath(), hpath(folder, f"{stem}-{n:05d}.parquet")):
            raise OSError(f"could not publish {part.getPath().toString()}")
        dates.add(folder.getName().split("=", 1)[1])
    for day in sorted(dates):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({PARTITION_COLUMN} = DATE '{day}')")


def write_stream_batch(batch: DataFrame, batch_id: int, table: str, checkpoint: str,
                       records_per_file: int | None = None) -> int | None:
    """One micro-batch into the table, once per checkpoint and id; the rows written, None if it was done before."""
    spark = batch.sparkSession
    mark = _batch_mark(checkpoint, batch_id)
    if object_exists(spark, mark, f"{mark}/_SUCCESS"):
        return None
    if not takes_batches(spark, table) and is_v2(spark, table):
        written = write_refs(batch, table, "append").records_written
    else:
        stem = f"stream-{hashlib.sha1(checkpoint.rstrip('/').encode()).hexdigest()[:12]}-{int(batch_id):012d}"
        whole = takes_batches(spark, table)
        written = published_batch(spark, table, stem) if whole else None
        if written is None:
            obs = Observation("linkyard_stream_batch")
            rows = batch.select(*FILE_REFS_COLUMNS).observe(obs, F.count(F.lit(1)).alias("written"))
            with session_conf(spark, {"spark.sql.files.maxRecordsPerFile": str(int(records_per_file)) if records_per_file else None}):
                if whole:
                    write_batch_files(rows, table, stem)
                else:
                    # Below the table, so that publishing is a rename; readers skip names with an underscore.
                    staged = f"{table_location(spark, table).rstrip('/')}/_linkyard_stream/{stem}"
                    rows.write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(staged)
            written = int(obs.get["written"])
            if whole:
                publish_batch(spark, table, stem)
            else:
                _publish(spark, staged, table, stem)
    spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id"), F.lit(written).cast("long").alias("records_written")) \
        .write.mode("overwrite").parquet(mark)
    return written


def committed_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """T3: ``(batch_id, records_written)`` of every batch that reached the table, however many there are."""
    if not object_exists(spark, f"{checkpoint.rstrip('/')}/linkyard_batches_done"):
        return spark.createDataFrame([], "batch_id long, records_written long")
    return spark.read.parquet(f"{checkpoint.rstrip('/')}/linkyard_batches_done/*")


def stream_into_table(
    spark: SparkSession,
    src_dir: str,
    table: str,
    checkpoint: str,
    entity_name: str,
    entity_type: str = DEFAULT_ENTITY_TYPE,
    as_of: str | dt.date | None = None,
    as_of_ts: str | dt.datetime | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    line_sep: str | None = None,
    processing_time: str | None = None,
    records_per_file: int | None = None,
    spread: bool | None = None,
) -> StreamingQuery:
    """T1/T4: each micro-batch into ``table``, once.  ``checkpoint`` names the stream: give the
    same one to every run over the same source and table."""
    df = streaming_file_refs(spark, src_dir, entity_name, entity_type, as_of, as_of_ts,
                             max_files_per_trigger, line_sep, spread=spread)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_stream_batch(batch, batch_id, table, checkpoint, records_per_file)
        # The batch runs in the stream's own session: the caller's must list the new files too.
        spark.catalog.refreshTable(batches_name(table) if takes_batches(spark, table) else table)

    w = df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


_COUNTERS = ("refs", "in_network_count", "allowed_amount_count", "other_count")


def _progress_row(p) -> dict:
    metrics = (p.observedMetrics or {}).get(PROGRESS_NAME)
    row = {"batch_id": int(p.batchId), "input_rows": int(p.numInputRows)}
    for k in _COUNTERS:
        row[k] = int(metrics[k]) if metrics is not None else 0
    return row


def progress_rows(query: StreamingQuery) -> list[dict]:
    """T3: per micro-batch ``batch_id``, input rows and the observed counters.

    Only the last ``spark.sql.streaming.numRecentProgressUpdates`` batches
    are kept by the query; ``ProgressRecorder`` totals all of them, and
    ``committed_batches`` lists every batch of a table stream.
    """
    return [_progress_row(p) for p in query.recentProgress]


class ProgressRecorder(StreamingQueryListener):
    """T3: micro-batch counters, as Spark reports each trigger.

    Keeps each query's totals over all its batches and the last ``keep`` rows; every
    ``every``-th row goes to ``on_report`` (periodic logging) and the last ``keep`` of them to ``reports``.
    """

    def __init__(self, every: int = 1, on_report=None, keep: int = 1000):
        self.every, self.keep = max(1, int(every)), keep
        self.on_report = on_report
        self.rows: dict[str, deque] = {}
        self.totals: dict[str, dict] = {}
        self.reports: deque = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:  # noqa: N802 (Spark's listener API)
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row, query = _progress_row(event.progress), str(event.progress.id)
        self.rows.setdefault(query, deque(maxlen=self.keep)).append(row)
        total = self.totals.setdefault(query, dict.fromkeys(("batches", "input_rows", *_COUNTERS), 0))
        total["batches"] += row["input_rows"] > 0
        for k in ("input_rows", *_COUNTERS):
            total[k] += row[k]
        if row["batch_id"] % self.every == 0:
            self.reports.append(row)
            if self.on_report is not None:
                self.on_report(row)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def for_query(self, query: StreamingQuery) -> list[dict]:
        return list(self.rows.get(str(query.id), []))
