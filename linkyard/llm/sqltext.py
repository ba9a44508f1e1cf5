"""Pieces of DuckDB SQL that several oracles share."""

from __future__ import annotations

#: A CTE with the 256 entries of the CRC-32 table, from its polynomial.
CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT range AS n, list_reduce([range] || range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(256))
)"""


def crc32_of(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string expression, where ``crc_table`` is joined in."""
    return (f"xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda d: CAST(ord(d) AS BIGINT)), "
            "lambda x, b: xor(x >> 8, t[1 + (xor(x, b) & 255)])), 4294967295)")
