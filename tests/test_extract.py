"""Extraction and classification: goldens X1, X2 and brute force."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkyard.operators import classified_refs, extract_refs, file_refs, ref_counters
from linkyard.sources import read_lines

from .fixtures import X2_EXPECTED, X2_LINES, duckdb_classes, scan_refs, write_text, x1_lines


def _lines_df(spark, lines):
    return spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "line_no long, value string")


def test_x1_counts_from_gzip_file(spark, workdir):
    path = write_text(f"{workdir}/idx/index.json.gz", x1_lines(), gz=True)
    lines = read_lines(spark, path)
    assert lines.count() == 102
    c = classified_refs(lines)
    row = ref_counters(c).first()
    assert row["total_file_refs_identified"] == 200
    assert (row["in_network_count"], row["allowed_amount_count"], row["other_count"]) == (68, 66, 66)
    types = {r["file_type"]: r["count"] for r in c.groupBy("file_type").count().collect()}
    assert types == {"json.gz": 68, "json": 66, "csv": 66}


def test_x2_golden_rows(spark, workdir):
    path = write_text(f"{workdir}/x2/edge.txt", X2_LINES)
    lines = read_lines(spark, path)
    assert lines.count() == 19
    got = sorted(tuple(r) for r in classified_refs(lines)
                 .select("line_no", "pos", "file_url", "file_network", "file_type").collect())
    assert got == sorted(X2_EXPECTED)


def test_x2_equals_scanner(spark):
    df = _lines_df(spark, X2_LINES)
    got = sorted(tuple(r) for r in extract_refs(df).select("line_no", "pos", "file_url").collect())
    want = sorted((i, p, u) for i, line in enumerate(X2_LINES) for p, u in enumerate(scan_refs(line)))
    assert got == want


def test_bare_then_keyed_order_and_duplicates(spark):
    df = _lines_df(spark, ['{"url": "https://x/a.csv"} https://y/b.gz'])
    got = [r["file_url"] for r in extract_refs(df).orderBy("pos").collect()]
    assert got == ["https://x/a.csv", "https://y/b.gz", "https://x/a.csv"]
    assert [r["file_url"] for r in extract_refs(df, "bare").orderBy("pos").collect()] == got[:2]
    assert [r["file_url"] for r in extract_refs(df, "keyed").collect()] == got[2:]


def test_file_refs_record_shape(spark):
    df = _lines_df(spark, x1_lines())
    out = file_refs(df, "E", "payer", "2025-05-01", "2025-05-01 00:00:00")
    assert out.columns == [
        "reporting_entity_name", "reporting_entity_type", "plan_name", "plan_id", "plan_market_type",
        "file_url", "file_network", "file_type", "file_date", "extracted_ts"]
    assert [f.dataType.simpleString() for f in out.schema.fields][-2:] == ["date", "timestamp"]
    r = out.where(F.col("file_url").endswith("file0.json.gz")).first()
    assert (r["reporting_entity_name"], r["plan_name"], str(r["file_date"])) == ("E", None, "2025-05-01")


_TOKENS = [
    "https://", "http://", "HTTP://", '"url"', '"URL"', ":", " : ", '"', "'", "(", ")", "[", "]", "{", "}",
    " ", "\u00a0", "\u001c", "\u001f", "\u3000", "\u2028", "\t", "\u0085", ",", ".", "a", "Z9", "/",
    "e.com", ".json", ".csv", ".gz", ".json.gz", "in-network", "IN-Network", "allowed-amount", "?x=1",
    "\\", "é", "漢", "\U0001F600", "\U00010348", "\x00", "\u200b", "\ufeff",
]


_SOUP = st.lists(st.sampled_from(_TOKENS), max_size=14).map("".join)
# URL-shaped lines (bare or keyed starts, random tails) mixed with free soup.
_LINE = st.one_of(
    _SOUP,
    st.tuples(
        st.sampled_from(["", "x ", '{"url": "', '"url":"', '{"URL": "', '"url" :\u3000"', "'"]),
        st.sampled_from(["https://", "http://", "HTTPS://", "https:/", "https://e.com/"]),
        _SOUP,
        st.sampled_from(['"', "", '"}', " ", '"},{"url": "https://b/', "\u00a0"]),
        _SOUP,
    ).map("".join),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_LINE, min_size=20, max_size=80))
def test_random_lines_match_scanner(spark, lines):
    df = _lines_df(spark, lines)
    got = sorted(tuple(r) for r in classified_refs(df)
                 .select("line_no", "pos", "file_url", "file_network", "file_type").collect())
    assert [g[:3] for g in got] == sorted((i, p, u) for i, line in enumerate(lines) for p, u in enumerate(scan_refs(line)))
    plain = [g[2:] for g in got if g[2].isascii() and "\x00" not in g[2]]
    classes = duckdb_classes([g[0] for g in plain])
    assert all(classes[u] == (n, t) for u, n, t in plain)


def test_page_lines_match_scanner(spark):
    from linkyard.sources import page_lines

    from .conftest import SF_MID

    lines = page_lines(spark.read.parquet(f"{SF_MID}/pages.parquet"))
    rows = lines.collect()
    got = sorted(tuple(r) for r in classified_refs(lines)
                 .select("line_no", "pos", "file_url", "file_network", "file_type").collect())
    want = sorted((r["line_no"], p, u) for r in rows for p, u in enumerate(scan_refs(r["value"])))
    assert [g[:3] for g in got] == want
    classes = duckdb_classes([g[2] for g in got])
    assert all(classes[g[2]] == g[3:] for g in got)
    assert {g[3] for g in got} == {"in-network", "allowed-amount", "other"}
    assert {"gz", "json.gz", "csv", "unknown"} <= {g[4] for g in got}
