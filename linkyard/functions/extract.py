"""Column expressions that pull URL references out of a text column.

All of these are plain Catalyst expressions (``regexp_extract_all`` with a
literal pattern, compiled once per task), so they stay inside whole-stage
codegen; no row ever goes to Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import BARE_URL, KEYED_URL, KEYED_URL_GROUP, URL_MARKER


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bare_urls(value: Column | str) -> Column:
    """All bare URL matches of ``value``, left to right (ARRAY<STRING>)."""
    return F.regexp_extract_all(_col(value), F.lit(BARE_URL), 0)


def keyed_urls(value: Column | str) -> Column:
    """All ``"url": "http..."`` values of ``value``, left to right."""
    return F.regexp_extract_all(_col(value), F.lit(KEYED_URL), KEYED_URL_GROUP)


def might_hold_url(value: Column | str) -> Column:
    """Cheap pre-filter: true for every line that can yield a reference."""
    return _col(value).contains(URL_MARKER)


def is_http(url: Column | str) -> Column:
    """The ``startswith('http')`` guard on a matched value."""
    return _col(url).startswith(URL_MARKER)
