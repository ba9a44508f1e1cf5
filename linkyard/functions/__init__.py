"""Column-level building blocks (all built-in Spark expressions, no UDF)."""

from .classify import file_type_of, network_of
from .extract import bare_urls, is_http, keyed_urls, might_hold_url
from .urls import format_hms, url_authority, url_key, url_path, url_scheme

__all__ = [
    "bare_urls", "keyed_urls", "is_http", "might_hold_url",
    "network_of", "file_type_of",
    "url_scheme", "url_authority", "url_path", "url_key", "format_hms",
]
