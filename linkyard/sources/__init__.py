"""Sources: text index files, derived index lines, listings."""

from .derived import (
    generate_index_lines, header_text, index_line_value, index_lines_from,
    lineitem_lines, order_lines, page_lines, varied_order_lines, write_index_files,
)
from .inventory import file_inventory, object_exists
from .landing import (
    file_pieces, land_files, land_raw, landed_digests, landed_pieces, raw_lines_with_source, raw_manifest, raw_zone,
)
from .lines import read_lines, read_lines_ordered, read_lines_raw, read_lines_stream

__all__ = [
    "read_lines", "read_lines_raw", "read_lines_ordered", "read_lines_stream",
    "index_lines_from", "index_line_value", "order_lines", "varied_order_lines", "lineitem_lines", "page_lines",
    "generate_index_lines", "header_text", "write_index_files",
    "file_inventory", "object_exists", "raw_lines_with_source", "land_raw", "raw_zone",
    "file_pieces", "land_files", "landed_pieces", "landed_digests", "raw_manifest",
]
