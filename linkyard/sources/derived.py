"""Index lines derived from table rows, and the sample index generator (S4).

The generator writes the shape of a payer's index file: a header line, one
``{"url": ...},`` line per id with the directory and suffix cycling by
``id % 3``, and a closing line.  Here the ids come from a table column, so
the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import DEFAULT_ENTITY_TYPE
from ..operators.ordering import with_ordinal
from .spread import spread_if_narrow

# The generated index line shape.
SAMPLE_HOST = "https://example.com/"
SAMPLE_DIRS = ["in-network/file", "allowed-amount/file", "other/file"]  # by id % 3
SAMPLE_EXTS = [".json.gz", ".json", ".csv"]  # by id % 3
LINE_PREFIX = '{"url": "'
LINE_SUFFIX = '"},'
FOOTER = "]}"
MAX_PARTS = 100_000


def header_text(entity_name: str, entity_type: str = DEFAULT_ENTITY_TYPE) -> str:
    return (
        f'{{"reporting_entity_name": "{entity_name}", '
        f'"reporting_entity_type": "{entity_type}", "data": ['
    )


def _by_mod3(k: Column, choices: list[str]) -> Column:
    m = F.pmod(k, F.lit(3))
    return F.when(m == 0, choices[0]).when(m == 1, choices[1]).otherwise(choices[2])


def index_line_value(k: Column | str) -> Column:
    """The generated line for integer id ``k``."""
    k = F.col(k) if isinstance(k, str) else k
    return F.concat(
        F.lit(LINE_PREFIX), F.lit(SAMPLE_HOST), _by_mod3(k, SAMPLE_DIRS),
        k.cast("string"), _by_mod3(k, SAMPLE_EXTS), F.lit(LINE_SUFFIX),
    )


def index_lines_from(df: DataFrame, key: str, spread: bool | None = None) -> DataFrame:
    """One index line per row: ``(line_no = key, value)``; key must be unique."""
    src = spread_if_narrow(df.select(key), [key], force=spread)
    return src.select(F.col(key).cast("long").alias("line_no"), index_line_value(key).alias("value"))


def order_lines(orders: DataFrame) -> DataFrame:
    """The derived index used by the checked queries: one line per order."""
    return index_lines_from(orders, "o_orderkey")


def varied_order_lines(orders: DataFrame, spread: bool | None = None) -> DataFrame:
    """One line per order with ``o_orderkey % 6`` references (0 to 5): plain text, bare URLs
    and keyed members in turn, so encounter order and weights differ from line to line."""
    k = F.col("o_orderkey")

    def url(i: int) -> Column:
        return F.concat(F.lit(SAMPLE_HOST), _by_mod3(k + i, SAMPLE_DIRS), k.cast("string"), F.lit(f"-{i}"), _by_mod3(k + i, SAMPLE_EXTS))

    keyed = [F.concat(F.lit(LINE_PREFIX), url(i), F.lit(LINE_SUFFIX)) for i in (1, 2)]
    n = F.pmod(k, F.lit(6))
    value = (F.when(n == 0, F.concat(F.lit("note "), k.cast("string")))
             .when(n == 1, F.concat(F.lit("see "), url(1)))
             .when(n == 2, keyed[0])
             .when(n == 3, F.concat(keyed[0], F.lit(" see "), url(2)))
             .when(n == 4, F.concat(*keyed))
             .otherwise(F.concat(*keyed, F.lit(" see "), url(3))))
    src = spread_if_narrow(orders.select("o_orderkey"), ["o_orderkey"], force=spread)
    return src.select(k.cast("long").alias("line_no"), value.alias("value"))


def lineitem_lines(lineitem: DataFrame) -> DataFrame:
    """A larger derived index: one line per lineitem (key = orderkey * 8 + linenumber)."""
    keyed = lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_lk_key"))
    return index_lines_from(keyed, "_lk_key")


# The index line built around a real-looking URL (page lines).
# by page_id % 3: the suffix of the mirror URL.
MIRROR_SUFFIXES = ["/in-network.json.gz", "/Allowed-Amount.CSV.gz", "/x.csv"]


def page_lines(pages: DataFrame, spread: bool | None = None) -> DataFrame:
    """One index line per page: the URL keyed, a mirror URL, and the URL bare
    in prose (once before a period, once in parentheses)."""
    src = pages.select("page_id", "url")
    src = spread_if_narrow(src, ["page_id"], force=spread)
    u = F.col("url")
    value = F.concat(
        F.lit('{"url": "'), u, F.lit('", "mirror": "'), u, _by_mod3(F.col("page_id"), MIRROR_SUFFIXES),
        F.lit('"} see '), u, F.lit(". ("), u, F.lit(")"),
    )
    return src.select(F.col("page_id").cast("long").alias("line_no"), value.alias("value"))


def generate_index_lines(ids: DataFrame, id_col: str, entity_name: str,
                         entity_type: str = DEFAULT_ENTITY_TYPE) -> DataFrame:
    """S4: a whole index as ``(line_no, value)``: header, one line per id, footer.

    Body lines are numbered by the rank of their id (1-based); the footer's
    number is the id count + 1.  Header and footer are one-row aggregates of
    ``ids``, so no row is made up on the driver.
    """
    body = with_ordinal(ids.select(F.col(id_col).cast("long").alias("_lk_id")), ["_lk_id"], "_lk_ord")
    body = body.select((F.col("_lk_ord") + 1).alias("line_no"), index_line_value("_lk_id").alias("value"))
    counted = ids.agg(F.count(F.lit(1)).alias("_lk_n"))
    header = ids.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("line_no"), F.lit(header_text(entity_name, entity_type)).alias("value"))
    footer = counted.select((F.col("_lk_n") + 1).cast("long").alias("line_no"), F.lit(FOOTER).alias("value"))
    return header.unionByName(body).unionByName(footer)


def write_index_files(lines: DataFrame, path: str, compression: str | None = "gzip") -> str:
    """Write ``lines`` as text files in ``line_no`` order (part files follow the order).

    The range-partitioned sort keeps part-file names in line order, so reading
    the folder back by path order gives the lines back in order.  Part numbers have
    five digits; there are never more parts than they can order.
    """
    parts = min(MAX_PARTS, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = lines.repartitionByRange(parts, "line_no").sortWithinPartitions("line_no")
    writer = ordered.select("value").write.mode("errorifexists")
    writer.option("compression", compression or "none").text(path)
    return path
