"""
an independent DuckDB statement of each result in ``oracle_sql()``.

Input of the reference-extraction queries: one index line per ``orders`` row
(``line_no = o_orderkey``), in the shape of a payer's index file, so every
query reads a whole driver table and grows with it.  ``page_refs`` and
``url_parts`` read ``pages.url``; ``format_hms`` reads ``events``.  Write,
listing and stream queries write to fresh places under the session's
checkpoint folder and read back.

Fixed literals pin the run date and time, so results are deterministic.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkyard.functions.patterns import BARE_URL_RE2, KEYED_URL_RE2
from linkyard.functions.urls import url_authority, url_key, format_hms
from linkyard.operators import (
    assign_batches, batch_counts, cap_records, classified_refs, detailed_lines, extract_refs, file_refs, filter_http,
    reconcile, reconcile_files, ref_counters, refs_by_network, sample_urls, summary_lines,
)
from linkyard.schema import FILE_REFS_COLUMNS, FILE_REFS_SCHEMA
from linkyard.session import scratch_path, unique_table_name
from linkyard.sinks import committed_files, ensure_stream_table, ensure_table, table_exists, table_location, table_rows, write_refs
from linkyard.sources import (
    file_inventory, generate_index_lines, land_files, land_raw, landed_digests, object_exists, order_lines, page_lines, read_lines, read_lines_ordered,
    read_lines_raw, varied_order_lines, write_index_files,
)
from linkyard.operators.files import cap_file_refs, first_file_refs
from linkyard.operators.ordering import with_ordinal
from linkyard.plans import ExtractionConfig, extract_index_file, run_extraction
from linkyard.streaming import committed_batches, progress_rows, stream_file_refs, stream_into_table

# Fixed values of the checked runs.
ENTITY = "Example Health Plan"
ENTITY_TYPE = "payer"
AS_OF = "2025-05-01"
AS_OF_TS = "2025-05-01 00:00:00"
EARLIER_DATE = "2025-04-01"
EARLIER_TS = "2025-04-01 00:00:00"
BATCH_SIZE = 10_000
SMALL_CAP = 1_000
LARGE_CAP = 12_345
STREAM_BATCHES = 4
STREAM_GROUPS, FILES_PER_GROUP = 3, 4
LINES_PER_FILE = 1_000_000  # of a source file that is also read whole, for its own digest
INVENTORY_FOLDERS, INVENTORY_EMPTY = 5, ["_note", ".hidden", "empty.txt"]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(_t(spark, sf_dir, "orders"))


def _varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with 0 to 5 references each: the hard part of the global index."""
    return varied_order_lines(_t(spark, sf_dir, "orders"))


def _classified(spark, sf_dir):
    return classified_refs(_lines(spark, sf_dir))


def _instant(ts: str) -> dt.datetime:
    """A run timestamp as a UTC instant, so it does not move with the session zone."""
    return dt.datetime.fromisoformat(ts).replace(tzinfo=dt.timezone.utc)


def _refs10(spark, sf_dir, as_of=AS_OF, as_of_ts=AS_OF_TS):
    return file_refs(_lines(spark, sf_dir), ENTITY, ENTITY_TYPE, as_of, _instant(as_of_ts))


def _fresh_table(spark: SparkSession, tag: str) -> str:
    name = unique_table_name(tag)
    ensure_table(spark, name, "parquet", scratch_path(spark, f"table-{tag}"))
    return name


def q_scan_lines(spark, sf_dir):
    """S1: write the generated index as gzip text, read it back numbered."""
    gen = generate_index_lines(_t(spark, sf_dir, "orders"), "o_orderkey", ENTITY, ENTITY_TYPE)
    path = write_index_files(gen, scratch_path(spark, "index-gz"))
    back = read_lines(spark, path)
    numbered = with_ordinal(back, ["file_path", "line_no"], "global_line_no")
    return numbered.select(F.col("global_line_no").alias("line_no"), "value")


def q_scan_text_lines(spark, sf_dir):
    """S1, plain text: one scan with an order key, numbered by those who ask for it."""
    gen = generate_index_lines(_t(spark, sf_dir, "orders"), "o_orderkey", ENTITY, ENTITY_TYPE)
    path = write_index_files(gen, scratch_path(spark, "index-txt"), compression=None)
    numbered = with_ordinal(read_lines_ordered(spark, path), ["file_path", "split", "record"], "global_line_no")
    return numbered.select(F.col("global_line_no").alias("line_no"), "value")


def _varied_files(spark, sf_dir, tag, compression=None):
    """The varied lines as text files in line order."""
    return write_index_files(_varied(spark, sf_dir), scratch_path(spark, tag), compression)


def q_file_batch_assign(spark, sf_dir):
    """W1 over files: references numbered in the scan tasks, no text is shuffled."""
    lines = read_lines_ordered(spark, _varied_files(spark, sf_dir, "index-batches"))
    return assign_batches(lines, BATCH_SIZE).select("ref_index", "batch_no", "pos", "file_url")


def q_file_max_records(spark, sf_dir):
    """L3 over gzip files: the first files in path order until the cap is met, the others stay closed."""
    return cap_file_refs(spark, _varied_files(spark, sf_dir, "index-cap", "gzip"), SMALL_CAP).select("pos", "file_url")


def q_file_sample_20(spark, sf_dir):
    """L1 over files: a top-k on references in the scan tasks."""
    return first_file_refs(spark, _varied_files(spark, sf_dir, "index-sample"), 20).select("sample_rank", "file_url")


def q_one_line_index_refs(spark, sf_dir):
    """S1 with ``line_sep``: each written file is one long line of JSON
    objects; reading it with ``line_sep="},"`` cuts it back into objects."""
    path = scratch_path(spark, "index-one-line")
    (_lines(spark, sf_dir).select("value").write.option("lineSep", " ")
     .option("compression", "gzip").text(path))
    return file_refs(read_lines_raw(spark, path, line_sep="},"), ENTITY, ENTITY_TYPE, AS_OF, _instant(AS_OF_TS))


def q_gen_index_lines(spark, sf_dir):
    return generate_index_lines(_t(spark, sf_dir, "orders"), "o_orderkey", ENTITY, ENTITY_TYPE)


def q_extract_bare(spark, sf_dir):
    return extract_refs(_lines(spark, sf_dir), "bare")


def q_extract_keyed(spark, sf_dir):
    return extract_refs(_lines(spark, sf_dir), "keyed")


def q_extract_refs(spark, sf_dir):
    return extract_refs(_lines(spark, sf_dir), "both")


def q_filter_http(spark, sf_dir):
    return filter_http(extract_refs(_lines(spark, sf_dir), "both"))


def q_classify_network(spark, sf_dir):
    return _classified(spark, sf_dir).select("line_no", "pos", "file_url", "file_network")


def q_classify_file_type(spark, sf_dir):
    return _classified(spark, sf_dir).select("line_no", "pos", "file_url", "file_type")


def q_file_refs(spark, sf_dir):
    return _refs10(spark, sf_dir)


def q_page_refs(spark, sf_dir):
    """P1-P7 on real-looking URLs (query strings, fragments, mixed case)."""
    return classified_refs(page_lines(_t(spark, sf_dir, "pages")))


def q_network_counts(spark, sf_dir):
    return ref_counters(_classified(spark, sf_dir)).select(
        "in_network_count", "allowed_amount_count", "other_count")


def q_total_refs(spark, sf_dir):
    return ref_counters(_classified(spark, sf_dir)).select("total_file_refs_identified")


def q_refs_by_network(spark, sf_dir):
    return refs_by_network(_classified(spark, sf_dir))


def q_sample_20(spark, sf_dir):
    return sample_urls(_classified(spark, sf_dir), 20)


def q_sample_15(spark, sf_dir):
    return sample_urls(_classified(spark, sf_dir), 15)


def q_max_records(spark, sf_dir):
    return cap_records(_varied(spark, sf_dir), SMALL_CAP)


def q_max_records_large(spark, sf_dir):
    return cap_records(_varied(spark, sf_dir), LARGE_CAP)


def q_batch_assign(spark, sf_dir):
    return assign_batches(_varied(spark, sf_dir), BATCH_SIZE)


def q_batch_counts(spark, sf_dir):
    return batch_counts(_classified(spark, sf_dir), BATCH_SIZE)


def q_table_columns(spark, sf_dir):
    """K1: the created table's columns, types and non-null counts after a write."""
    t = _fresh_table(spark, "cols")
    write_refs(_refs10(spark, sf_dir), t)
    types = {f.name: f.dataType.simpleString() for f in spark.table(t).schema.fields}
    counts = spark.table(t).agg(*[F.count(c).cast("long").alias(c) for c in FILE_REFS_COLUMNS])
    long_form = counts.unpivot([], FILE_REFS_COLUMNS, "col_name", "non_null")
    pos = F.create_map(*[x for i, c in enumerate(FILE_REFS_COLUMNS) for x in (F.lit(c), F.lit(i + 1))])
    typ = F.create_map(*[x for c in FILE_REFS_COLUMNS for x in (F.lit(c), F.lit(types[c]))])
    return long_form.select(
        F.element_at(pos, F.col("col_name")).alias("ordinal"), "col_name",
        F.element_at(typ, F.col("col_name")).alias("data_type"), "non_null")


def q_table_exists(spark, sf_dir):
    """K2: existence of a created table and of a missing one, with its row count."""
    t = _fresh_table(spark, "exists")
    write_refs(_refs10(spark, sf_dir), t)
    present, missing = table_exists(spark, t), table_exists(spark, unique_table_name("missing"))
    return spark.table(t).agg(
        F.lit(present).alias("table_exists"), F.lit(missing).alias("missing_table_exists"),
        F.count(F.lit(1)).cast("long").alias("n_rows"))


def q_write_append(spark, sf_dir):
    t = _fresh_table(spark, "append")
    write_refs(_refs10(spark, sf_dir), t, "append")
    return table_rows(spark, t)


def _per_date_net(spark, t):
    return spark.table(t).groupBy("file_date", "file_network").agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"))


def q_append_twice(spark, sf_dir):
    """K6 default: a re-run appends everything again."""
    t = _fresh_table(spark, "twice")
    write_refs(_refs10(spark, sf_dir), t, "append")
    write_refs(_refs10(spark, sf_dir), t, "append")
    return _per_date_net(spark, t)


def q_replace_date_twice(spark, sf_dir):
    """K6 opt-in: a re-run replaces its own date and keeps the other date."""
    t = _fresh_table(spark, "replace")
    write_refs(_refs10(spark, sf_dir, EARLIER_DATE, EARLIER_TS), t, "append")
    write_refs(_refs10(spark, sf_dir), t, "replace_date")
    write_refs(_refs10(spark, sf_dir), t, "replace_date")
    return _per_date_net(spark, t)


def q_reconcile(spark, sf_dir):
    """A5 + A7: references identified vs rows that reached the table."""
    t = _fresh_table(spark, "reconcile")
    write_refs(_refs10(spark, sf_dir), t)
    return reconcile(_classified(spark, sf_dir), table_rows(spark, t, AS_OF))


def _job(spark, sf_dir):
    """The whole job (K1, K3, A1-A5, L1, L2, K8): one observed write + the top-k sample."""
    cfg = ExtractionConfig(table=unique_table_name("job"), entity_name=ENTITY, entity_type=ENTITY_TYPE,
                           batch_size=BATCH_SIZE, location=scratch_path(spark, "table-job"),
                           as_of=AS_OF, as_of_ts=_instant(AS_OF_TS))
    return run_extraction(spark, _lines(spark, sf_dir), cfg), cfg


def q_run_result(spark, sf_dir):
    return _job(spark, sf_dir)[0].result


def q_index_file_job(spark, sf_dir):
    """The whole job over gzip index files written in key order: one uncached
    observed write, the sample from the first lines."""
    path = write_index_files(_varied(spark, sf_dir), scratch_path(spark, "index-job"))
    cfg = ExtractionConfig(table=unique_table_name("filejob"), entity_name=ENTITY, entity_type=ENTITY_TYPE,
                           batch_size=BATCH_SIZE, location=scratch_path(spark, "table-filejob"),
                           as_of=AS_OF, as_of_ts=_instant(AS_OF_TS))
    return extract_index_file(spark, path, cfg).result


def q_summary_report(spark, sf_dir):
    """K7: the summary lists the counters and the 20-URL sample."""
    job, _ = _job(spark, sf_dir)
    return summary_lines(job.report, "file_refs", BATCH_SIZE, job.batch_count, AS_OF_TS)


def q_detailed_report(spark, sf_dir):
    """K7: the second report, with place, shares and columns."""
    job, _ = _job(spark, sf_dir)
    return detailed_lines(job.report, "file_refs", AS_OF_TS)


def q_replace_date_empty(spark, sf_dir):
    """K6: a replacing run without references leaves its date empty and keeps the others."""
    t = _fresh_table(spark, "replace_empty")
    write_refs(_refs10(spark, sf_dir, EARLIER_DATE, EARLIER_TS), t, "append")
    write_refs(_refs10(spark, sf_dir), t, "append")
    none = _refs10(spark, sf_dir).where(F.col("file_url").isNull())
    write_refs(none, t, "replace_date", run_date=AS_OF)
    return _per_date_net(spark, t)


def _stream_source(spark, sf_dir):
    """The derived index as gzip text files, one per partition of the lines
    (so the number of files grows with the table), and a micro-batch size
    that splits them into about ``STREAM_BATCHES`` batches."""
    path = scratch_path(spark, "stream-src")
    _lines(spark, sf_dir).select("value").write.option("compression", "gzip").text(path)
    n_files = len(spark.read.text(path)._jdf.inputFiles())
    return path, max(1, -(-n_files // STREAM_BATCHES))


def q_stream_file_refs(spark, sf_dir):
    src, per_batch = _stream_source(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    q = stream_file_refs(spark, src, sink, ckpt, ENTITY, ENTITY_TYPE, AS_OF, _instant(AS_OF_TS),
                         max_files_per_trigger=per_batch)
    q.awaitTermination()
    return spark.read.parquet(sink).select(*FILE_REFS_COLUMNS)


def q_stream_progress(spark, sf_dir):
    src, per_batch = _stream_source(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    q = stream_file_refs(spark, src, sink, ckpt, ENTITY, ENTITY_TYPE, AS_OF, _instant(AS_OF_TS),
                         max_files_per_trigger=per_batch)
    q.awaitTermination()
    rows = [r for r in progress_rows(q) if r["input_rows"] > 0]
    per_batch = spark.createDataFrame(
        rows, "batch_id long, input_rows long, refs long, in_network_count long, "
              "allowed_amount_count long, other_count long")
    # The per-batch counters observed by the stream must add up to the totals.
    return per_batch.agg(*[F.sum(c).cast("long").alias(c) for c in
                           ("input_rows", "refs", "in_network_count", "allowed_amount_count", "other_count")])


def _forget_last_batch(spark, ckpt):
    """As after a crash between the table's files and the end of the last batch: its mark and Spark's commit entry are gone."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(ckpt).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last = max(int(f.getPath().getName()) for f in fs.globStatus(hpath(f"{ckpt}/commits/[0-9]*")))
    fs.delete(hpath(f"{ckpt}/commits/{last}"), False)
    fs.delete(hpath(f"{ckpt}/linkyard_batches_done/{last}"), True)


def q_stream_table_refs(spark, sf_dir):
    """T1/T4 into a table, with the last batch replayed as after a crash between the
    table's files and the end of the batch: its mark and Spark's commit entry are gone."""
    src, per_batch = _stream_source(spark, sf_dir)
    t, ckpt = _fresh_table(spark, "stream"), scratch_path(spark, "stream-table-ckpt")

    def run():
        stream_into_table(spark, src, t, ckpt, ENTITY, ENTITY_TYPE, AS_OF, _instant(AS_OF_TS),
                          max_files_per_trigger=per_batch).awaitTermination()

    run()
    _forget_last_batch(spark, ckpt)
    run()
    return table_rows(spark, t)


def q_stream_whole_batches(spark, sf_dir):
    """T1: a stream into a table that takes whole batches, the last batch replayed; with the rows of each batch as its partitions hold them."""
    src, per_batch = _stream_source(spark, sf_dir)
    t, ckpt = unique_table_name("streambatches"), scratch_path(spark, "stream-batches-ckpt")
    ensure_stream_table(spark, t, "parquet", scratch_path(spark, "table-streambatches"))

    def run():
        stream_into_table(spark, src, t, ckpt, ENTITY, ENTITY_TYPE, AS_OF, _instant(AS_OF_TS), max_files_per_trigger=per_batch).awaitTermination()

    run()
    _forget_last_batch(spark, ckpt)
    run()
    return table_rows(spark, t)


def q_stream_batches(spark, sf_dir):
    """T2: number and rows of the micro-batches, from the committed marks.

    The source gets three groups of lines one after the other, each in as many files as a micro-batch takes."""
    src, lines = scratch_path(spark, "stream-groups"), _varied(spark, sf_dir)
    for group in range(STREAM_GROUPS):
        some = lines.where(F.pmod("line_no", F.lit(STREAM_GROUPS)) == group).select("value").repartition(FILES_PER_GROUP)
        some.write.mode("append").option("compression", "gzip").text(src)
    t, ckpt = unique_table_name("streamgroups"), scratch_path(spark, "stream-groups-ckpt")
    ensure_stream_table(spark, t, "parquet", scratch_path(spark, "table-streamgroups"))
    stream_into_table(spark, src, t, ckpt, ENTITY, ENTITY_TYPE, AS_OF, _instant(AS_OF_TS), max_files_per_trigger=FILES_PER_GROUP).awaitTermination()
    return committed_batches(spark, ckpt).select("batch_id", "records_written")


def q_reconcile_loss(spark, sf_dir):
    """K5/A7: two writes, then the files of the second are lost; the footers that are left tell what is missing."""
    t, lines = _fresh_table(spark, "loss"), _varied(spark, sf_dir)
    observed, kept = 0, None
    for group in (0, 1):
        rows = file_refs(lines.where(F.pmod("line_no", F.lit(2)) == group), ENTITY, ENTITY_TYPE, AS_OF, _instant(AS_OF_TS))
        observed += write_refs(rows, t).records_written
        kept = kept or [r["file"] for r in committed_files(spark, t).collect()]  # of the first write
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(table_location(spark, t)).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in committed_files(spark, t).where(~F.col("file").isin(kept)).collect():
        fs.delete(hpath(r["file"]), False)
    spark.catalog.refreshTable(t)
    return reconcile_files(observed, committed_files(spark, t, AS_OF))


def q_url_parts(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    return pages.select("page_id", "url", url_authority("url").alias("authority"),
                        url_key("url").alias("url_key"))


def q_format_hms(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    span = ev.groupBy("event_type").agg(
        (F.expr("timestampdiff(MICROSECOND, min(ts), max(ts))") / F.lit(1_000_000.0)).alias("elapsed_s"))
    return span.select("event_type", "elapsed_s", format_hms("elapsed_s").alias("hms"))


def _text_index(spark, sf_dir, tag: str) -> str:
    """The derived index as plain text: every line's bytes and one line feed."""
    path = scratch_path(spark, tag)
    _lines(spark, sf_dir).select("value").write.option("compression", "none").text(path)
    return path


def q_file_inventory(spark, sf_dir):
    """S5: every file of a tree by folder, name and bytes, with an underscore name, a dot name and an empty file."""
    src, lines = scratch_path(spark, "inventory-src"), _lines(spark, sf_dir)
    grouped = lines.select((F.col("line_no") % INVENTORY_FOLDERS).alias("folder"), "value")
    # One file a folder: a folder's lines meet in one task.
    grouped.repartition(INVENTORY_FOLDERS, "folder").write.partitionBy("folder").option("compression", "none").text(src)
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(src).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in INVENTORY_EMPTY:
        fs.create(hpath(f"{src}/{name}"), True).close()
    found = file_inventory(spark, src).select(F.substring_index("path", "/inventory-src-", -1).alias("p"), "length")
    found = found.select(F.expr("substr(p, instr(p, '/') + 1)").alias("p"), "length")
    return found.select(F.when(F.col("p").startswith("folder="), F.substring_index("p", "/", 1)).otherwise(F.col("p")).alias("path"), "length")


def q_object_exists(spark, sf_dir):
    """S6: the written index folder and its success mark exist, a missing folder does not."""
    src = _text_index(spark, sf_dir, "exists-src")
    hit, miss = object_exists(spark, src), object_exists(spark, src + "-missing")
    mark = object_exists(spark, src, f"{src}/_SUCCESS")
    return _t(spark, sf_dir, "orders").agg(
        F.lit(hit).alias("root_exists"), F.lit(miss).alias("missing_exists"), F.lit(mark).alias("mark_exists"),
        F.count(F.lit(1)).cast("long").alias("n_lines"))


def q_land_raw(spark, sf_dir):
    """S7: the source's files can be put together again from the zone: its lines in order, with provenance."""
    src = write_index_files(_lines(spark, sf_dir), scratch_path(spark, "land-src"))
    zone = land_raw(spark, src, scratch_path(spark, "raw"))
    kept = zone.select(F.col("source_path").alias("file_path"), "line_no", "value", (
        (F.col("source_size") > 0) & F.col("source_mtime").isNotNull()).alias("has_provenance"))
    return with_ordinal(kept, ["file_path", "line_no"], "global_line_no").select(
        F.col("global_line_no").alias("line_no"), "value", "has_provenance")


def q_land_files(spark, sf_dir):
    """S7: files as bytes. The index as plain text with CR line ends and as gzip, both landed twice; every rebuilt
    file's digest is compared with that of the source's bytes."""
    src = scratch_path(spark, "land-bytes")
    lines = _lines(spark, sf_dir).select("value")
    lines.write.option("maxRecordsPerFile", LINES_PER_FILE).option("compression", "none").option("lineSep", "\r\n").text(f"{src}/plain")
    lines.write.option("maxRecordsPerFile", LINES_PER_FILE).option("compression", "gzip").text(f"{src}/gz")
    raw = scratch_path(spark, "raw-bytes")
    land_files(spark, src, raw)
    land_files(spark, src, raw)
    rebuilt = landed_digests(spark, raw).withColumn("source_path", F.regexp_replace("source_path", "^file:/+", "file:///"))
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src).select(
        F.regexp_replace("path", "^file:/+", "file:///").alias("source_path"), "length", F.sha2("content", 256).alias("own"))
    same = own.join(rebuilt, "source_path", "left").withColumn("plain", F.col("source_path").contains("/plain/"))
    equal = F.coalesce((F.col("own") == F.col("sha256")) & (F.col("length") == F.col("n_bytes")), F.lit(False))
    return same.agg(F.sum(F.when(F.col("plain"), F.col("n_bytes"))).alias("plain_bytes"), F.count_if(~F.col("plain") & equal).alias("_gz"),
                    F.count_if(~equal).alias("n_differ")).select("plain_bytes", (F.col("_gz") > 0).alias("compressed_landed"), "n_differ")


def q_land_raw_emptied(spark, sf_dir):
    """S7: files that have become empty, landed again, leave no old line behind."""
    src, lines = scratch_path(spark, "land-emptied"), _lines(spark, sf_dir)
    for odd in (0, 1):
        lines.where(F.col("line_no") % 2 == odd).select("value").write.option("compression", "none").text(f"{src}/part{odd}")
    raw = scratch_path(spark, "raw-emptied")
    land_raw(spark, src, raw)
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(src).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.globStatus(hpath(f"{src}/part1/part-*")):
        fs.create(f.getPath(), True).close()
    return land_raw(spark, src, raw).select("value")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the file-reference records of the sf0.001 derived index."""
    return q_file_refs(spark, "/root/testdata/sf0.001")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_lines": q_scan_lines,
    "scan_text_lines": q_scan_text_lines,
    "one_line_index_refs": q_one_line_index_refs,
    "gen_index_lines": q_gen_index_lines,
    "extract_bare": q_extract_bare,
    "extract_keyed": q_extract_keyed,
    "extract_refs": q_extract_refs,
    "filter_http": q_filter_http,
    "classify_network": q_classify_network,
    "classify_file_type": q_classify_file_type,
    "file_refs": q_file_refs,
    "page_refs": q_page_refs,
    "network_counts": q_network_counts,
    "total_refs": q_total_refs,
    "refs_by_network": q_refs_by_network,
    "sample_20": q_sample_20,
    "sample_15": q_sample_15,
    "max_records": q_max_records,
    "max_records_large": q_max_records_large,
    "batch_assign": q_batch_assign,
    "file_batch_assign": q_file_batch_assign,
    "file_max_records": q_file_max_records,
    "file_sample_20": q_file_sample_20,
    "batch_counts": q_batch_counts,
    "table_columns": q_table_columns,
    "table_exists": q_table_exists,
    "write_append": q_write_append,
    "append_twice": q_append_twice,
    "replace_date_twice": q_replace_date_twice,
    "reconcile": q_reconcile,
    "summary_report": q_summary_report,
    "run_result": q_run_result,
    "index_file_job": q_index_file_job,
    "stream_file_refs": q_stream_file_refs,
    "url_parts": q_url_parts,
    "format_hms": q_format_hms,
    "file_inventory": q_file_inventory,
    "object_exists": q_object_exists,
    "land_raw": q_land_raw,
    "land_raw_emptied": q_land_raw_emptied,
    "land_files": q_land_files,
    "replace_date_empty": q_replace_date_empty,
    "detailed_report": q_detailed_report,
    "stream_table_refs": q_stream_table_refs,
    "stream_progress": q_stream_progress,
    "stream_whole_batches": q_stream_whole_batches,
    "stream_batches": q_stream_batches,
    "reconcile_loss": q_reconcile_loss,
}


# The training-data operators live in a subpackage of their own that may be absent.
try:
    from linkyard.llm import queries as _llm
except ImportError as _missing:  # the subpackage, or a library that it alone needs
    logging.getLogger(__name__).warning("training-data queries are left out: %s", _missing)
    _llm = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **(_llm.QUERIES if _llm else {})}


# ---------------------------------------------------------------------------
# DuckDB side: an independent statement of each result.
# ---------------------------------------------------------------------------

def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LINES = (
    "SELECT CAST(o_orderkey AS BIGINT) AS line_no, "
    """'{"url": "https://example.com/' || CASE o_orderkey % 3 WHEN 0 THEN 'in-network/file' """
    """WHEN 1 THEN 'allowed-amount/file' ELSE 'other/file' END || CAST(o_orderkey AS VARCHAR) || """
    """CASE o_orderkey % 3 WHEN 0 THEN '.json.gz' WHEN 1 THEN '.json' ELSE '.csv' END || '"},' AS value """
    "FROM orders"
)
def _varied_url(i: int) -> str:
    return (f"'https://example.com/' || CASE (o_orderkey + {i}) % 3 WHEN 0 THEN 'in-network/file' WHEN 1 THEN 'allowed-amount/file' "
            f"ELSE 'other/file' END || CAST(o_orderkey AS VARCHAR) || '-{i}' || "
            f"CASE (o_orderkey + {i}) % 3 WHEN 0 THEN '.json.gz' WHEN 1 THEN '.json' ELSE '.csv' END")


def _varied_keyed(i: int) -> str:
    return "'{\"url\": \"' || " + _varied_url(i) + " || '\"},'"


VARIED = (
    "SELECT CAST(o_orderkey AS BIGINT) AS line_no, CASE o_orderkey % 6 WHEN 0 THEN 'note ' || CAST(o_orderkey AS VARCHAR) "
    f"WHEN 1 THEN 'see ' || {_varied_url(1)} WHEN 2 THEN {_varied_keyed(1)} "
    f"WHEN 3 THEN {_varied_keyed(1)} || ' see ' || {_varied_url(2)} WHEN 4 THEN {_varied_keyed(1)} || {_varied_keyed(2)} "
    f"ELSE {_varied_keyed(1)} || {_varied_keyed(2)} || ' see ' || {_varied_url(3)} END AS value FROM orders"
)
_BARE = f"regexp_extract_all(value, {_s(BARE_URL_RE2)}, 0)"
_KEYED = f"regexp_extract_all(value, {_s(KEYED_URL_RE2)}, 1)"


def _refs(arr: str, lines: str = LINES) -> str:
    return (
        f"WITH lines AS ({lines}), m AS (SELECT line_no, {arr} AS arr FROM lines) "
        "SELECT line_no, CAST(p AS INTEGER) AS pos, arr[p + 1] AS file_url "
        "FROM m, unnest(range(len(arr))) AS t(p)"
    )


REFS = _refs(f"list_concat({_BARE}, {_KEYED})")
VARIED_REFS = _refs(f"list_concat({_BARE}, {_KEYED})", VARIED)
NET = ("CASE WHEN contains(lower(file_url), 'in-network') THEN 'in-network' "
       "WHEN contains(lower(file_url), 'allowed-amount') THEN 'allowed-amount' ELSE 'other' END")
FTYPE = ("CASE WHEN ends_with(file_url, '.json.gz') THEN 'json.gz' WHEN ends_with(file_url, '.csv.gz') THEN 'csv.gz' "
         "WHEN ends_with(file_url, '.json') THEN 'json' WHEN ends_with(file_url, '.csv') THEN 'csv' "
         "WHEN ends_with(file_url, '.gz') THEN 'gz' ELSE 'unknown' END")
def _classified_sql(refs: str) -> str:
    return (f"SELECT line_no, pos, file_url, {NET} AS file_network, {FTYPE} AS file_type "
            f"FROM ({refs}) r WHERE starts_with(file_url, 'http')")


CLASSIFIED = _classified_sql(REFS)
VARIED_CLASSIFIED = _classified_sql(VARIED_REFS)


def _file_refs_sql(as_of: str = AS_OF, as_of_ts: str = AS_OF_TS) -> str:
    return (
        f"SELECT {_s(ENTITY)} AS reporting_entity_name, {_s(ENTITY_TYPE)} AS reporting_entity_type, "
        "CAST(NULL AS VARCHAR) AS plan_name, CAST(NULL AS VARCHAR) AS plan_id, "
        "CAST(NULL AS VARCHAR) AS plan_market_type, file_url, file_network, file_type, "
        f"DATE {_s(as_of)} AS file_date, TIMESTAMP {_s(as_of_ts)} AS extracted_ts "
        f"FROM ({CLASSIFIED}) c"
    )


FILE_REFS = _file_refs_sql()
PAGE_LINES = (
    "SELECT CAST(page_id AS BIGINT) AS line_no, '{\"url\": \"' || url || '\", \"mirror\": \"' || url || "
    "CASE page_id % 3 WHEN 0 THEN '/in-network.json.gz' WHEN 1 THEN '/Allowed-Amount.CSV.gz' ELSE '/x.csv' END "
    "|| '\"} see ' || url || '. (' || url || ')' AS value FROM pages"
)
PAGE_REFS = (
    f"WITH lines AS ({PAGE_LINES}), m AS (SELECT line_no, list_concat({_BARE}, {_KEYED}) AS arr FROM lines), "
    "r AS (SELECT line_no, CAST(p AS INTEGER) AS pos, arr[p + 1] AS file_url FROM m, unnest(range(len(arr))) AS t(p)) "
    f"SELECT line_no, pos, file_url, {NET} AS file_network, {FTYPE} AS file_type FROM r "
    "WHERE starts_with(file_url, 'http')"
)
def _counters_sql(classified: str) -> str:
    return (
    "SELECT CAST(count(*) FILTER (WHERE file_network = 'in-network') AS BIGINT) AS in_network_count, "
    "CAST(count(*) FILTER (WHERE file_network = 'allowed-amount') AS BIGINT) AS allowed_amount_count, "
    "CAST(count(*) FILTER (WHERE file_network = 'other') AS BIGINT) AS other_count, "
    f"CAST(count(*) AS BIGINT) AS total_file_refs_identified FROM ({classified}) c"
    )


COUNTERS = _counters_sql(CLASSIFIED)


def _sample(n: int, classified: str = CLASSIFIED) -> str:
    return (f"SELECT CAST(row_number() OVER (ORDER BY line_no, pos) AS INTEGER) AS sample_rank, line_no, pos, file_url "
            f"FROM (SELECT line_no, pos, file_url FROM ({classified}) c ORDER BY line_no, pos LIMIT {n}) s")


def _indexed_sql(classified: str) -> str:
    return (f"SELECT line_no, pos, file_url, CAST(row_number() OVER (ORDER BY line_no, pos) - 1 AS BIGINT) AS ref_index "
            f"FROM ({classified}) c")


INDEXED = _indexed_sql(CLASSIFIED)

GEN = (
    "SELECT CAST(0 AS BIGINT) AS line_no, "
    f"{_s('{\"reporting_entity_name\": \"' + ENTITY + '\", \"reporting_entity_type\": \"' + ENTITY_TYPE + '\", \"data\": [')} AS value "
    "UNION ALL "
    f"SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS line_no, v AS value "
    f"FROM (SELECT o_orderkey, value AS v FROM ({LINES}) l JOIN orders ON o_orderkey = l.line_no) g "
    "UNION ALL "
    "SELECT CAST(count(*) + 1 AS BIGINT) AS line_no, ']}' AS value FROM orders"
)

_TYPES = {f.name: f.dataType.simpleString() for f in FILE_REFS_SCHEMA.fields}
TABLE_COLUMNS = " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS INTEGER) AS ordinal, {_s(c)} AS col_name, {_s(_TYPES[c])} AS data_type, "
    f"CAST(count({c}) AS BIGINT) AS non_null FROM ({FILE_REFS}) f"
    for i, c in enumerate(FILE_REFS_COLUMNS)
)

PER_DATE_NET = (
    "SELECT file_date, file_network, CAST(count(*) * {mult} AS BIGINT) AS n_rows FROM ({src}) f "
    "GROUP BY file_date, file_network"
)

def _result_sql(n: int, classified: str = CLASSIFIED) -> str:
    return (
        "SELECT c.total_file_refs_identified, c.total_file_refs_identified AS total_records_written, "
        "c.in_network_count, c.allowed_amount_count, c.other_count, s.sample_urls FROM "
        f"({_counters_sql(classified)}) c, "
        f"(SELECT list(file_url ORDER BY sample_rank) AS sample_urls FROM ({_sample(n, classified)}) x) s"
    )


RUN_RESULT = _result_sql(15)

_SUMMARY_HEAD = [
    "'File reference extraction summary'",
    f"'Completed: ' || {_s(AS_OF_TS)}",
    "'References identified: ' || CAST(total_file_refs_identified AS VARCHAR)",
    "'Records written: ' || CAST(total_records_written AS VARCHAR)",
    "'Not written: ' || CAST(total_file_refs_identified - total_records_written AS VARCHAR)",
    "'In-network: ' || CAST(in_network_count AS VARCHAR)",
    "'Allowed-amount: ' || CAST(allowed_amount_count AS VARCHAR)",
    "'Other: ' || CAST(other_count AS VARCHAR)",
    f"'Batches: ' || CAST((total_file_refs_identified + {BATCH_SIZE - 1}) // {BATCH_SIZE} AS VARCHAR)",
    f"'Batch size: ' || '{BATCH_SIZE}'",
    "'Catalog: session catalog'",
    "'Table: file_refs'",
    "'Warehouse: catalog default'",
    "'Sample URLs: ' || CAST(len(sample_urls) AS VARCHAR)",
]
SUMMARY = (
    f"WITH r AS ({_result_sql(20)}), lines AS (SELECT list_concat([{', '.join(_SUMMARY_HEAD)}], "
    "list_transform(sample_urls, lambda u: '- ' || u)) AS arr FROM r) "
    "SELECT CAST(p AS INTEGER) AS line_no, arr[p + 1] AS text FROM lines, unnest(range(len(arr))) AS t(p)"
)


def _share(label: str, name: str) -> str:
    return (f"'{label}: ' || CAST({name} AS VARCHAR) || ' (' || "
            f"printf('%.2f', CASE WHEN total_file_refs_identified > 0 THEN {name} * 100 / total_file_refs_identified ELSE 0.0 END) || ' %)'")


DETAILS = (
    f"WITH r AS ({_result_sql(20)}), lines AS (SELECT ['File reference extraction, details', 'Completed: {AS_OF_TS}', "
    "'Catalog: session catalog', 'Table: file_refs', 'Warehouse: catalog default', "
    "'References identified: ' || CAST(total_file_refs_identified AS VARCHAR), "
    "'Records written: ' || CAST(total_records_written AS VARCHAR), "
    f"{_share('In-network', 'in_network_count')}, {_share('Allowed-amount', 'allowed_amount_count')}, {_share('Other', 'other_count')}, "
    f"'Columns: {', '.join(FILE_REFS_COLUMNS)}'] AS arr FROM r) "
    "SELECT CAST(p AS INTEGER) AS line_no, arr[p + 1] AS text FROM lines, unnest(range(len(arr))) AS t(p)"
)

# Cut at positions, without the library's pattern: scheme up to the first colon (if it is one),
# authority from // to the next of / ? #, path up to ? or #, parameters from ; in the last segment.
_CLEAN_URL = r"regexp_replace(regexp_replace(url, '[\t\r\n]', '', 'g'), '^[\x00-\x20]+', '')"
URL_PARTS = (
    f"WITH c AS (SELECT page_id, url, {_CLEAN_URL} AS cu FROM pages), "
    "s AS (SELECT *, strpos(cu, ':') AS colon, lower(left(cu, greatest(strpos(cu, ':') - 1, 0))) AS word FROM c), "
    "v AS (SELECT *, colon > 1 AND word[1] BETWEEN 'a' AND 'z' AND "
    "translate(word, 'abcdefghijklmnopqrstuvwxyz0123456789+.-', '') = '' AS has_scheme FROM s), "
    "a AS (SELECT *, CASE WHEN has_scheme THEN word ELSE '' END AS scheme, "
    "CASE WHEN has_scheme THEN substr(cu, colon + 1) ELSE cu END AS rest FROM v), "
    "n AS (SELECT *, starts_with(rest, '//') AS has_net, substr(rest, 3) AS body FROM a), "
    "e AS (SELECT *, least(CASE WHEN strpos(body, '/') > 0 THEN strpos(body, '/') ELSE 1000000 END, "
    "CASE WHEN strpos(body, '?') > 0 THEN strpos(body, '?') ELSE 1000000 END, "
    "CASE WHEN strpos(body, '#') > 0 THEN strpos(body, '#') ELSE 1000000 END) AS stop FROM n), "
    "p AS (SELECT *, CASE WHEN has_net THEN left(body, stop - 1) ELSE '' END AS authority, "
    "split_part(split_part(CASE WHEN has_net THEN substr(body, stop) ELSE rest END, '#', 1), '?', 1) AS path FROM e), "
    "l AS (SELECT *, list_last(string_split(path, '/')) AS seg FROM p) "
    "SELECT page_id, url, authority, ltrim(CASE WHEN scheme IN "
    "('', 'ftp', 'hdl', 'prospero', 'http', 'imap', 'https', 'shttp', 'rtsp', 'rtsps', 'rtspu', "
    "'sip', 'sips', 'mms', 'sftp', 'tel') "
    "THEN left(path, length(path) - length(seg)) || split_part(seg, ';', 1) ELSE path END, '/') AS url_key FROM l"
)

FORMAT_HMS = (
    "SELECT event_type, elapsed_s, "
    "CAST(floor(elapsed_s / 3600) AS BIGINT) || 'h ' || CAST(floor(fmod(elapsed_s, 3600) / 60) AS BIGINT) || 'm ' "
    "|| CAST(floor(fmod(elapsed_s, 60)) AS BIGINT) || 's' AS hms FROM ("
    "SELECT event_type, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS elapsed_s "
    "FROM events GROUP BY event_type) e"
)

_ORACLE: dict[str, str] = {
    "scan_lines": GEN,
    "scan_text_lines": GEN,
    "one_line_index_refs": FILE_REFS,
    "gen_index_lines": GEN,
    "extract_bare": _refs(_BARE),
    "extract_keyed": _refs(_KEYED),
    "extract_refs": REFS,
    "filter_http": f"SELECT * FROM ({REFS}) r WHERE starts_with(file_url, 'http')",
    "classify_network": f"SELECT line_no, pos, file_url, file_network FROM ({CLASSIFIED}) c",
    "classify_file_type": f"SELECT line_no, pos, file_url, file_type FROM ({CLASSIFIED}) c",
    "file_refs": FILE_REFS,
    "page_refs": PAGE_REFS,
    "network_counts": f"SELECT in_network_count, allowed_amount_count, other_count FROM ({COUNTERS}) c",
    "total_refs": f"SELECT total_file_refs_identified FROM ({COUNTERS}) c",
    "refs_by_network": f"SELECT file_network, CAST(count(*) AS BIGINT) AS n_refs FROM ({CLASSIFIED}) c GROUP BY file_network",
    "sample_20": _sample(20),
    "sample_15": _sample(15),
    "max_records": f"SELECT line_no, pos, file_url FROM ({VARIED_REFS}) r ORDER BY line_no, pos LIMIT {SMALL_CAP}",
    "max_records_large": f"SELECT line_no, pos, file_url FROM ({VARIED_REFS}) r ORDER BY line_no, pos LIMIT {LARGE_CAP}",
    "batch_assign": f"SELECT *, CAST(ref_index // {BATCH_SIZE} + 1 AS BIGINT) AS batch_no FROM ({_indexed_sql(VARIED_CLASSIFIED)}) i",
    "file_batch_assign": (f"SELECT ref_index, CAST(ref_index // {BATCH_SIZE} + 1 AS BIGINT) AS batch_no, pos, file_url "
                          f"FROM ({_indexed_sql(VARIED_CLASSIFIED)}) i"),
    "file_max_records": f"SELECT pos, file_url FROM (SELECT * FROM ({VARIED_REFS}) r ORDER BY line_no, pos LIMIT {SMALL_CAP}) c",
    "file_sample_20": f"SELECT sample_rank, file_url FROM ({_sample(20, VARIED_CLASSIFIED)}) s",
    "batch_counts": (
        f"SELECT CAST(ref_index // {BATCH_SIZE} + 1 AS BIGINT) AS batch_no, CAST(count(*) AS BIGINT) AS n_refs "
        f"FROM ({INDEXED}) i GROUP BY 1"
    ),
    "table_columns": TABLE_COLUMNS,
    "table_exists": f"SELECT true AS table_exists, false AS missing_table_exists, CAST(count(*) AS BIGINT) AS n_rows FROM ({FILE_REFS}) f",
    "write_append": FILE_REFS,
    "append_twice": PER_DATE_NET.format(mult=2, src=FILE_REFS),
    "replace_date_twice": PER_DATE_NET.format(
        mult=1, src=f"{FILE_REFS} UNION ALL {_file_refs_sql(EARLIER_DATE, EARLIER_TS)}"),
    "reconcile": (f"SELECT CAST(count(*) AS BIGINT) AS identified, CAST(count(*) AS BIGINT) AS written, "
                  f"CAST(0 AS BIGINT) AS lost FROM ({CLASSIFIED}) c"),
    "summary_report": SUMMARY,
    "run_result": RUN_RESULT,
    "index_file_job": _result_sql(15, VARIED_CLASSIFIED),
    "detailed_report": DETAILS,
    "replace_date_empty": PER_DATE_NET.format(mult=1, src=_file_refs_sql(EARLIER_DATE, EARLIER_TS)),
    "stream_table_refs": FILE_REFS,
    "stream_whole_batches": FILE_REFS,
    "stream_batches": (f"SELECT CAST(line_no % {STREAM_GROUPS} AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS records_written "
                       f"FROM ({VARIED_CLASSIFIED}) c GROUP BY 1"),
    "reconcile_loss": (f"SELECT CAST(count(*) AS BIGINT) AS identified, CAST(count(*) FILTER (line_no % 2 = 0) AS BIGINT) AS written, "
                       f"CAST(count(*) FILTER (line_no % 2 = 1) AS BIGINT) AS lost FROM ({VARIED_CLASSIFIED}) c"),
    "file_inventory": (f"SELECT 'folder=' || CAST(line_no % {INVENTORY_FOLDERS} AS VARCHAR) AS path, CAST(sum(strlen(value) + 1) AS BIGINT) AS length "
                       f"FROM ({LINES}) l GROUP BY 1 UNION ALL "
                       f"SELECT unnest([{', '.join(_s(n) for n in [*INVENTORY_EMPTY, '_SUCCESS'])}]), CAST(0 AS BIGINT)"),
    "land_files": f"SELECT CAST(sum(strlen(value) + 2) AS BIGINT) AS plain_bytes, true AS compressed_landed, CAST(0 AS BIGINT) AS n_differ FROM ({LINES}) l",
    "object_exists": ("SELECT true AS root_exists, false AS missing_exists, true AS mark_exists, "
                      "CAST(count(*) AS BIGINT) AS n_lines FROM orders"),
    "land_raw_emptied": f"SELECT value FROM ({LINES}) l WHERE line_no % 2 = 0",
    "stream_file_refs": FILE_REFS,
    "stream_progress": (
        f"SELECT (SELECT CAST(count(*) AS BIGINT) FROM orders) AS input_rows, c.total_file_refs_identified AS refs, "
        f"c.in_network_count, c.allowed_amount_count, c.other_count FROM ({COUNTERS}) c"
    ),
    "land_raw": (f"SELECT CAST(row_number() OVER (ORDER BY line_no) - 1 AS BIGINT) AS line_no, value, "
                 f"true AS has_provenance FROM ({LINES}) l"),
    "url_parts": URL_PARTS,
    "format_hms": FORMAT_HMS,
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each checked key."""
    return {**_ORACLE, **(_llm.ORACLES if _llm else {})}
