"""Structured Streaming ingest of index files."""

from .ingest import (
    ProgressRecorder, committed_batches, progress_rows, stream_file_refs, stream_into_table, streaming_file_refs, write_stream_batch,
)

__all__ = ["streaming_file_refs", "stream_file_refs", "stream_into_table", "progress_rows", "ProgressRecorder",
           "committed_batches", "write_stream_batch"]
