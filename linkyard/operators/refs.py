"""Lines -> file references -> classified, typed file-reference records.

A *lines* DataFrame has a ``value`` string column and a line key: ``line_no``
alone, ``(file_path, line_no)`` or ``(file_path, split, record)``.  Every operator here is a
narrow projection/explode over it, so the whole chain runs as one
whole-stage-codegen stage right behind the scan, with no shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import file_type_of, network_of
from ..functions.extract import bare_urls, is_http, keyed_urls, might_hold_url
from ..functions.patterns import DEFAULT_ENTITY_TYPE
from ..schema import FILE_REFS_SCHEMA

_EXTRACTORS = {
    "bare": lambda v: bare_urls(v),
    "keyed": lambda v: keyed_urls(v),
    "both": lambda v: F.concat(bare_urls(v), keyed_urls(v)),
}


def line_key(df: DataFrame) -> list[str]:
    """The columns that order lines: ``[file_path,] line_no``, or ``file_path, split, record`` (whatever exists)."""
    return [c for c in ("file_path", "split", "record", "line_no") if c in df.columns]


def ref_key(df: DataFrame) -> list[str]:
    """Encounter order of references: line key, then position in the line."""
    return line_key(df) + ["pos"]


def refs_array(value: Column | str = "value", which: str = "both") -> Column:
    """Matches of one line as an array (P1-P3 in one expression).

    Every match of both patterns starts with ``http``, so the P5 guard never
    removes an element; it is applied as a row filter after the explode
    (``filter_http``), which stays in whole-stage codegen where an array
    ``filter(x -> ...)`` would not.
    """
    return _EXTRACTORS[which](value)


def extract_refs(lines: DataFrame, which: str = "both", value: str = "value") -> DataFrame:
    """One row per match: ``(<line key>, pos INT, file_url STRING)``.

    ``which``: ``bare`` (P1), ``keyed`` (P2) or ``both`` (P3: bare matches
    first, then keyed ones; duplicates kept).  ``pos`` is the 0-based place
    in that per-line list.
    """
    keys = line_key(lines)
    return (
        lines.where(might_hold_url(value))
        .select(*keys, F.posexplode(_EXTRACTORS[which](value)).alias("pos", "file_url"))
    )


def filter_http(refs: DataFrame) -> DataFrame:
    """P5: keep values that start with ``http``."""
    return refs.where(is_http("file_url"))


def classify(refs: DataFrame) -> DataFrame:
    """P6 + P7: add ``file_network`` and ``file_type``."""
    return refs.select(
        "*",
        network_of("file_url").alias("file_network"),
        file_type_of("file_url").alias("file_type"),
    )


def classified_refs(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(<line key>, pos, file_url, file_network, file_type)`` for all refs."""
    return classify(filter_http(extract_refs(lines, "both", value)))


def _date_col(as_of: str | dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def _ts_col(as_of_ts: str | dt.datetime | None) -> Column:
    """Run timestamp: ``current_timestamp()``; a zone-aware datetime is an
    absolute instant (independent of the session time zone); a string or
    naive datetime is read in the session time zone, as Spark casts do."""
    if as_of_ts is None:
        return F.current_timestamp()
    if isinstance(as_of_ts, dt.datetime) and as_of_ts.tzinfo is not None:
        micros = (as_of_ts - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
        return F.timestamp_micros(F.lit(micros))
    return F.lit(str(as_of_ts)).cast("timestamp")


def to_file_refs(
    classified: DataFrame,
    entity_name: str,
    entity_type: str = DEFAULT_ENTITY_TYPE,
    as_of: str | dt.date | None = None,
    as_of_ts: str | dt.datetime | None = None,
) -> DataFrame:
    """P8 + P9: the 10-column record in table order.

    ``file_date``/``extracted_ts`` default to one value per query
    (``current_date()``/``current_timestamp()`` are fixed at planning), so a
    run is deterministic; pass literals to pin them.
    """
    values = {
        "reporting_entity_name": F.lit(entity_name),
        "reporting_entity_type": F.lit(entity_type),
        "plan_name": F.lit(None),
        "plan_id": F.lit(None),
        "plan_market_type": F.lit(None),
        "file_url": F.col("file_url"),
        "file_network": F.col("file_network"),
        "file_type": F.col("file_type"),
        "file_date": _date_col(as_of),
        "extracted_ts": _ts_col(as_of_ts),
    }
    return classified.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in FILE_REFS_SCHEMA.fields]
    )


def file_refs(
    lines: DataFrame,
    entity_name: str,
    entity_type: str = DEFAULT_ENTITY_TYPE,
    as_of: str | dt.date | None = None,
    as_of_ts: str | dt.datetime | None = None,
    value: str = "value",
) -> DataFrame:
    """The flagship transform: lines -> typed file-reference records."""
    return to_file_refs(classified_refs(lines, value), entity_name, entity_type, as_of, as_of_ts)
