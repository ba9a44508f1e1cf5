"""DataFrame -> DataFrame operators of the extraction job."""

from .metrics import (
    detailed_lines, reconcile, reconcile_files, ref_counters, refs_by_network, sample_urls, summary_lines,
)
from .ordering import (
    assign_batches, batch_counts, cap_records, exclusive_prefix_sum, first_refs, first_refs_of_lines,
    indexed_file_refs, indexed_refs, with_ordinal,
)
from .refs import (
    classified_refs, classify, extract_refs, file_refs, filter_http, line_key, ref_key, refs_array, to_file_refs,
)

__all__ = [
    "extract_refs", "filter_http", "classify", "classified_refs", "to_file_refs", "file_refs",
    "line_key", "ref_key", "refs_array",
    "exclusive_prefix_sum", "with_ordinal", "indexed_refs", "assign_batches", "batch_counts",
    "first_refs", "first_refs_of_lines", "indexed_file_refs", "cap_records",
    "ref_counters", "refs_by_network", "sample_urls", "reconcile", "reconcile_files",
    "summary_lines", "detailed_lines",
]
