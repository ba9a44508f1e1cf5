"""Counters, reconciliation, and reports (A1-A7, K7).

Each result is one aggregate over the references: partial counts per task,
one tiny final merge.  Where two inputs feed one row (source and table) they
are unioned and tagged, then aggregated once.  The run result itself is
built by the job (``plans.job``) from the counters of its write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import ALLOWED_AMOUNT, IN_NETWORK, OTHER, SAMPLE_SIZE
from ..schema import FILE_REFS_COLUMNS
from .ordering import first_refs
from .refs import ref_key


def _count_net(label: str) -> Column:
    return F.count_if(F.col("file_network") == label).cast("long")


def ref_counters(classified: DataFrame) -> DataFrame:
    """A1-A4 in one pass: per-class counts (0 for an empty class) and the total."""
    return classified.agg(
        _count_net(IN_NETWORK).alias("in_network_count"),
        _count_net(ALLOWED_AMOUNT).alias("allowed_amount_count"),
        _count_net(OTHER).alias("other_count"),
        F.count(F.lit(1)).cast("long").alias("total_file_refs_identified"),
    )


def refs_by_network(classified: DataFrame) -> DataFrame:
    """Group-by form of A1-A3 (no row for an empty class)."""
    return classified.groupBy("file_network").agg(F.count(F.lit(1)).cast("long").alias("n_refs"))


def sample_urls(refs: DataFrame, n: int = SAMPLE_SIZE) -> DataFrame:
    """L1: ``(sample_rank, <ref key>, file_url)`` of the first ``n`` references."""
    return first_refs(refs.select(*ref_key(refs), "file_url"), n)


def reconcile(identified: DataFrame, written: DataFrame) -> DataFrame:
    """A7: ``identified, written, lost`` from the source refs and the rows written.

    Both sides are tagged and unioned, then counted in one aggregate.
    """
    tagged = identified.select(F.lit(True).alias("_lk_src")).unionByName(
        written.select(F.lit(False).alias("_lk_src"))
    )
    return tagged.agg(
        F.count_if(F.col("_lk_src")).cast("long").alias("identified"),
        F.count_if(~F.col("_lk_src")).cast("long").alias("written"),
    ).withColumn("lost", F.col("identified") - F.col("written"))


def reconcile_files(observed: int | Column, files: DataFrame) -> DataFrame:
    """A7/K5: ``identified, written, lost``: what the writes of a run observed against the rows of the files that the table
    holds now (``sinks.committed_files``), so a file that got lost after its write shows."""
    seen = F.lit(observed) if isinstance(observed, int) else observed
    return files.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("written")).select(
        seen.cast("long").alias("identified"), "written", (seen.cast("long") - F.col("written")).alias("lost"))


def _kv(label: str, col: Column) -> Column:
    return F.concat(F.lit(label + ": "), col.cast("string"))


def _place_lines(table: str, catalog: str | None, warehouse: str | None) -> list[Column]:
    return [_kv("Catalog", F.lit(catalog or "session catalog")), _kv("Table", F.lit(table)),
            _kv("Warehouse", F.lit(warehouse or "catalog default"))]


def summary_lines(result: DataFrame, table: str, batch_size: int, batch_count: Column | int,
                  completed_at: Column | str, catalog: str | None = None, warehouse: str | None = None) -> DataFrame:
    """K7: the run summary as ``(line_no INT, text STRING)`` rows.

    Built from the one-row run result, so it needs no second pass.
    """
    ts = F.lit(completed_at) if isinstance(completed_at, str) else completed_at
    nb = F.lit(batch_count) if isinstance(batch_count, int) else batch_count
    head = F.array(
        F.lit("File reference extraction summary"),
        _kv("Completed", ts),
        _kv("References identified", F.col("total_file_refs_identified")),
        _kv("Records written", F.col("total_records_written")),
        _kv("Not written", F.col("total_file_refs_identified") - F.col("total_records_written")),
        _kv("In-network", F.col("in_network_count")),
        _kv("Allowed-amount", F.col("allowed_amount_count")),
        _kv("Other", F.col("other_count")),
        _kv("Batches", nb),
        _kv("Batch size", F.lit(int(batch_size))),
        *_place_lines(table, catalog, warehouse),
        _kv("Sample URLs", F.size("sample_urls")),
    )
    body = F.transform("sample_urls", lambda u: F.concat(F.lit("- "), u))
    return result.select(F.posexplode(F.concat(head, body)).alias("line_no", "text"))


def detailed_lines(result: DataFrame, table: str, completed_at: Column | str, catalog: str | None = None,
                   warehouse: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """K7, the second report: where the rows went, each class with its share of all references, and
    the table's columns, as ``(line_no INT, text STRING)``."""
    ts = F.lit(completed_at) if isinstance(completed_at, str) else completed_at
    total = F.col("total_file_refs_identified")

    def share(label: str, name: str) -> Column:
        part = F.when(total > 0, F.col(name) * 100 / total).otherwise(F.lit(0.0))
        return F.concat(F.lit(label + ": "), F.col(name).cast("string"), F.lit(" ("), F.format_string("%.2f", part), F.lit(" %)"))

    lines = F.array(
        F.lit("File reference extraction, details"), _kv("Completed", ts), *_place_lines(table, catalog, warehouse),
        _kv("References identified", total), _kv("Records written", F.col("total_records_written")),
        share("In-network", "in_network_count"), share("Allowed-amount", "allowed_amount_count"), share("Other", "other_count"),
        F.lit("Columns: " + ", ".join(columns or FILE_REFS_COLUMNS)),
    )
    return result.select(F.posexplode(lines).alias("line_no", "text"))
