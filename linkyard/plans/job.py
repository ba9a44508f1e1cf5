"""The whole extraction job: index lines -> catalog table + run result.

Plan of one run (``explain`` shows it):

* scan (text without line numbers, or any lines DataFrame) -> ``contains('http')``
  filter -> two ``regexp_extract_all`` + ``posexplode`` -> classify -> 10 columns ->
  one write job into the ``file_date``-partitioned table.  Nothing is cached; there is no
  shuffle (unless a lopsided scan is spread) and no Python in that stage.
* The counters of the run are observed on the write itself
  (``Observation``), so they cost no second pass.
* The sample (first 20 in encounter order) is a top-k on references in the scan tasks, over the first
  files in path order until there are enough, or over the first lines by key.  No line reaches the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import (
    ALLOWED_AMOUNT, DEFAULT_BATCH_SIZE, DEFAULT_ENTITY_TYPE, IN_NETWORK, OTHER, RESULT_SAMPLE_SIZE, SAMPLE_SIZE,
)
from ..operators.metrics import detailed_lines, summary_lines
from ..operators.files import cap_file_refs, first_file_refs
from ..operators.ordering import cap_records, first_refs_of_lines
from ..operators.refs import classified_refs, classify, filter_http, to_file_refs
from ..session import checkpoint_dir
from ..sinks.tables import ensure_table, write_refs
from ..sources.lines import read_lines_raw


@dataclass
class ExtractionConfig:
    table: str
    entity_name: str
    entity_type: str = DEFAULT_ENTITY_TYPE
    batch_size: int = DEFAULT_BATCH_SIZE
    max_records: int = 0
    mode: str = "append"
    provider: str = "parquet"
    location: str | None = None
    as_of: str | dt.date | None = None
    as_of_ts: str | dt.datetime | None = None
    records_per_file: int | None = None
    catalog: str | None = None
    warehouse: str | None = None


@dataclass
class ExtractionRun:
    result: DataFrame   # K8: counters + the first 15 URLs
    sample: DataFrame   # L1: the first 20 references, ranked
    report: DataFrame   # counters + all 20 sample URLs (what the summary lists)
    counters: dict = field(default_factory=dict)
    batch_count: int = 0

    def summary(self, cfg: ExtractionConfig, completed_at: str) -> DataFrame:
        return summary_lines(self.report, cfg.table, cfg.batch_size, self.batch_count, completed_at, cfg.catalog, cfg.warehouse)

    def details(self, cfg: ExtractionConfig, completed_at: str) -> DataFrame:
        return detailed_lines(self.report, cfg.table, completed_at, cfg.catalog, cfg.warehouse)


def run_extraction(spark: SparkSession, lines: DataFrame | None, cfg: ExtractionConfig,
                   sample: DataFrame | None = None, refs: DataFrame | None = None) -> ExtractionRun:
    """Extract, classify and write all references of ``lines``; return the run result.

    The write is one uncached pass over ``lines``, which need no numbers unless a cap is set.
    ``sample``: the first references, ranked, if the caller has found them
    already; else they are taken from the first (numbered) lines.  ``refs``: the references to write, instead of ``lines``.
    """
    ensure_table(spark, cfg.table, cfg.provider, cfg.location)
    # One date for the whole run, also for what a replacing run without rows clears.
    as_of = cfg.as_of or spark.range(1).select(F.current_date()).first()[0]
    if refs is not None:
        classified = classify(filter_http(refs))
    elif cfg.max_records > 0:
        classified = classify(filter_http(cap_records(lines, cfg.max_records)))
    else:
        classified = classified_refs(lines)
    rows = to_file_refs(classified, cfg.entity_name, cfg.entity_type, as_of, cfg.as_of_ts)
    net = F.col("file_network")
    report = write_refs(rows, cfg.table, cfg.mode, records_per_file=cfg.records_per_file, run_date=as_of, metrics={
        "in_network_count": F.count_if(net == IN_NETWORK),
        "allowed_amount_count": F.count_if(net == ALLOWED_AMOUNT),
        "other_count": F.count_if(net == OTHER),
    })
    if sample is None:
        sample = first_refs_of_lines(lines, _sample_size(cfg))
    checkpoint_dir(spark)
    sample = sample.select("sample_rank", "file_url").checkpoint(eager=True)  # 20 rows at most
    counters = dict(report.metrics)
    identified = counters["in_network_count"] + counters["allowed_amount_count"] + counters["other_count"]
    counters["total_file_refs_identified"] = identified
    batch_count = -(-identified // cfg.batch_size) if identified else 0

    # One report row: the counters and all SAMPLE_SIZE sample URLs (the
    # summary lists them); the run result keeps the first RESULT_SAMPLE_SIZE.
    report = sample.agg(F.sort_array(F.collect_list(F.struct("sample_rank", "file_url"))).alias("_s")).select(
        F.lit(identified).cast("long").alias("total_file_refs_identified"),
        F.lit(counters["written"]).cast("long").alias("total_records_written"),
        F.lit(counters["in_network_count"]).cast("long").alias("in_network_count"),
        F.lit(counters["allowed_amount_count"]).cast("long").alias("allowed_amount_count"),
        F.lit(counters["other_count"]).cast("long").alias("other_count"),
        F.transform("_s", lambda s: s["file_url"]).alias("sample_urls"),
    )
    result = report.withColumn("sample_urls", F.slice("sample_urls", 1, RESULT_SAMPLE_SIZE))
    return ExtractionRun(result=result, sample=sample, report=report, counters=counters, batch_count=batch_count)


def _sample_size(cfg: ExtractionConfig) -> int:
    return min(SAMPLE_SIZE, cfg.max_records) if cfg.max_records > 0 else SAMPLE_SIZE


def extract_index_file(spark: SparkSession, index_path: str, cfg: ExtractionConfig,
                       line_sep: str | None = None, spread: bool | None = None) -> ExtractionRun:
    """The job over text/gzip index files at ``index_path`` (any Hadoop scheme).

    The table itself has no order, so its lines are scanned without a key and may be spread; the sample, and the
    cap of a capped run, look at the first files in path order only."""
    sample = first_file_refs(spark, index_path, _sample_size(cfg), line_sep)
    if cfg.max_records > 0:
        return run_extraction(spark, None, cfg, sample, refs=cap_file_refs(spark, index_path, cfg.max_records, line_sep))
    return run_extraction(spark, read_lines_raw(spark, index_path, line_sep, spread), cfg, sample)


def write_summary(run: ExtractionRun, cfg: ExtractionConfig, path: str, completed_at: str) -> str:
    """K7 as a text file: a few dozen lines from one row, so one partition
    already holds them all; sort inside it, no range shuffle."""
    (run.summary(cfg, completed_at).coalesce(1).sortWithinPartitions("line_no").select("text")
     .write.mode("overwrite").text(path))
    return path


def write_details(run: ExtractionRun, cfg: ExtractionConfig, path: str, completed_at: str) -> str:
    """K7, the detailed report as a text file of its own."""
    (run.details(cfg, completed_at).coalesce(1).sortWithinPartitions("line_no").select("text")
     .write.mode("overwrite").text(path))
    return path
