"""Sinks: the file-reference catalog table."""

from .tables import (
    MODES, WriteReport, clear_date, committed_files, ensure_stream_table, ensure_table, table_exists, table_location, table_rows,
    takes_batches, write_refs,
)

__all__ = ["MODES", "WriteReport", "clear_date", "committed_files", "ensure_stream_table", "ensure_table", "table_exists", "table_location",
           "table_rows", "takes_batches", "write_refs"]
