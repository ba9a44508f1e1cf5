"""Network class and file type of a URL column, as CASE expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import FILE_TYPE_RULES, NETWORK_RULES, OTHER, UNKNOWN_TYPE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _first_hit(tests: list[tuple[Column, str]], default: str) -> Column:
    (cond0, label0), *rest = tests
    chain = reduce(lambda acc, t: acc.when(t[0], t[1]), rest, F.when(cond0, label0))
    return chain.otherwise(default)


def network_of(url: Column | str) -> Column:
    """Case-insensitive substring test, first rule that hits wins."""
    low = F.lower(_col(url))
    return _first_hit([(low.contains(s), label) for s, label in NETWORK_RULES], OTHER)


def file_type_of(url: Column | str) -> Column:
    """Case-sensitive suffix test, first rule that hits wins."""
    u = _col(url)
    return _first_hit([(u.endswith(s), label) for s, label in FILE_TYPE_RULES], UNKNOWN_TYPE)
