"""linkyard: file-reference extraction from index files, on Spark.

Text or gzip index files -> every URL (bare and JSON-keyed) -> network class
and file type -> a ``file_date``-partitioned catalog table, with counters,
samples, batch numbering and reconciliation, in batch or streaming.
"""

from .schema import FILE_REFS_COLUMNS, FILE_REFS_SCHEMA, file_refs_ddl

__all__ = ["FILE_REFS_SCHEMA", "FILE_REFS_COLUMNS", "file_refs_ddl"]
