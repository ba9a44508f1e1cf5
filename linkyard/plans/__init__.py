"""End-to-end job plans built from the operators."""

from .job import ExtractionConfig, ExtractionRun, extract_index_file, run_extraction, write_details, write_summary

__all__ = ["ExtractionConfig", "ExtractionRun", "extract_index_file", "run_extraction", "write_summary", "write_details"]
