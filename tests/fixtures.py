"""Fixture inputs X1 and X2 with hand-written expected rows (see FIXTURES.md), and a scanner
"""

from __future__ import annotations

import gzip
import os

# Characters that end a bare URL, besides white space.
URL_ENDS = "\"'()[]{}"


def _address_start(line: str, at: int) -> int:
    """Where the text after ``http://`` or ``https://`` begins, if one of them stands at ``at``; else -1."""
    for scheme in ("https://", "http://"):
        if line.startswith(scheme, at):
            return at + len(scheme)
    return -1


def scan_bare(line: str) -> list[str]:
    """Addresses in running text: a scheme and at least one character that does not end a URL."""
    found, at = [], 0
    while at < len(line):
        end = start = _address_start(line, at)
        while start >= 0 and end < len(line) and not line[end].isspace() and line[end] not in URL_ENDS:
            end += 1
        if start >= 0 and end > start:
            found.append(line[at:end])
            at = end
        else:
            at += 1
    return found


def _skip_space(line: str, at: int) -> int:
    while at < len(line) and line[at].isspace():
        at += 1
    return at


def scan_keyed(line: str) -> list[str]:
    """Addresses that are the quoted value of a member named url, up to the closing quote."""
    found, at = [], 0
    while at < len(line):
        nxt = at + 1
        if line.startswith('"url"', at):
            colon = _skip_space(line, at + 5)
            quote = _skip_space(line, colon + 1)
            if line[colon:colon + 1] == ":" and line[quote:quote + 1] == '"':
                start = _address_start(line, quote + 1)
                close = line.find('"', start) if start >= 0 else -1
                if close > start >= 0:
                    found.append(line[quote + 1:close])
                    nxt = close + 1
        at = nxt
    return found


def scan_refs(line: str) -> list[str]:
    """All references of a line: the bare ones first, then the keyed ones."""
    return scan_bare(line) + scan_keyed(line)


def duckdb_classes(urls: list[str]) -> dict[str, tuple[str, str]]:
    """Network and file type of each URL by the oracle's DuckDB expressions."""
    import duckdb
    import pandas as pd

    import __spark_entry__ as E

    con = duckdb.connect()
    con.register("u", pd.DataFrame({"file_url": sorted(set(urls))}, dtype="object"))
    return {u: (n, t) for u, n, t in con.execute(f"SELECT file_url, {E.NET}, {E.FTYPE} FROM u").fetchall()}


def x1_lines(entity: str = "E") -> list[str]:
    lines = [f'{{"reporting_entity_name": "{entity}", "reporting_entity_type": "payer", "data": [']
    for i in range(100):
        d, ext = [("in-network", ".json.gz"), ("allowed-amount", ".json"), ("other", ".csv")][i % 3]
        lines.append(f'{{"url": "https://example.com/{d}/file{i}{ext}"}},')
    lines.append("]}")
    return lines


X2_LINES = [
    '{"url": "https://e.com/in-network/a.json.gz"},',
    '{"url":"https://e.com/a(b)/x.csv"}',
    "plain https://e.com/q.json, and http://z/y.gz.",
    '{"location": "https://e.com/in-network/b.csv.gz"}',
    "https://e.com/IN-NETWORK/allowed-amount/c.JSON",
    "https://e.com/d.json.gz?Expires=1",
    "https:\\/\\/e.com\\/f.json",
    "HTTPS://E.COM/g",
    '{"url": "https://e.com/[x]/Allowed-Amount/y.gz"}',
    "https:// https://h",
    '{"URL": "https://e.com/i.zip"}',
    "",
    '{"url": "https://e.com/j k.csv"}',
    '{"url": "https://e.com/l.json\\"}',
    "nb https://e.com/m\u00a0n",
    "fs https://e.com/o\u001cp",
    "ideo https://e.com/r\u3000s",
    "it's 'https://e.com/t.csv'",
    '{"url":"https://a/1.gz"},{"url":"https://b/2.csv"}',
]

X2_EXPECTED = [
    (0, 0, "https://e.com/in-network/a.json.gz", "in-network", "json.gz"),
    (0, 1, "https://e.com/in-network/a.json.gz", "in-network", "json.gz"),
    (1, 0, "https://e.com/a", "other", "unknown"),
    (1, 1, "https://e.com/a(b)/x.csv", "other", "csv"),
    (2, 0, "https://e.com/q.json,", "other", "unknown"),
    (2, 1, "http://z/y.gz.", "other", "unknown"),
    (3, 0, "https://e.com/in-network/b.csv.gz", "in-network", "csv.gz"),
    (4, 0, "https://e.com/IN-NETWORK/allowed-amount/c.JSON", "in-network", "unknown"),
    (5, 0, "https://e.com/d.json.gz?Expires=1", "other", "unknown"),
    (8, 0, "https://e.com/", "other", "unknown"),
    (8, 1, "https://e.com/[x]/Allowed-Amount/y.gz", "allowed-amount", "gz"),
    (9, 0, "https://h", "other", "unknown"),
    (10, 0, "https://e.com/i.zip", "other", "unknown"),
    (12, 0, "https://e.com/j", "other", "unknown"),
    (12, 1, "https://e.com/j k.csv", "other", "csv"),
    (13, 0, "https://e.com/l.json\\", "other", "unknown"),
    (13, 1, "https://e.com/l.json\\", "other", "unknown"),
    (14, 0, "https://e.com/m", "other", "unknown"),
    (15, 0, "https://e.com/o", "other", "unknown"),
    (16, 0, "https://e.com/r", "other", "unknown"),
    (17, 0, "https://e.com/t.csv", "other", "csv"),
    (18, 0, "https://a/1.gz", "other", "gz"),
    (18, 1, "https://b/2.csv", "other", "csv"),
    (18, 2, "https://a/1.gz", "other", "gz"),
    (18, 3, "https://b/2.csv", "other", "csv"),
]


def write_text(path: str, lines: list[str], gz: bool = False, eol: str = "\n") -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = "".join(line + eol for line in lines)
    if gz:
        with gzip.open(path, "wt", encoding="utf-8", newline="") as f:
            f.write(data)
    else:
        with open(path, "w", encoding="utf-8", newline="") as f:
            f.write(data)
    return path
