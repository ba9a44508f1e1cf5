"""URL parts against urllib.parse, and the duration text."""

from __future__ import annotations

from urllib.parse import urlparse

from linkyard.functions import format_hms, url_authority, url_key

from .conftest import SF_MID

EDGE = [
    "s3a://my_b/payer/x/2025-05-01_index.json.gz",
    "https://user:pw@e.com:8443/a/b;p?q=1#f",
    "https://e.com/a;x/b.csv",
    "https://e.com/j k.csv",
    "https://e.com",
    "https://e.com?x=1",
    "http://h//double//slash",
    "file:///tmp/a.txt",
    "s3a://b/k;v",
    "https://e.com/in-network/a.json.gz",
    "https://e.com/a\tb",
    " \x01https://e.com/x",
    "https://e\n.com/p?q",
    "ht\ttps://e.com/z",
]


def test_url_parts_equal_urlparse(spark):
    pages = [r["url"] for r in spark.read.parquet(f"{SF_MID}/pages.parquet").select("url").collect()]
    urls = EDGE + pages
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r["u"]: (r["a"], r["k"]) for r in df.select("u", url_authority("u").alias("a"),
                                                            url_key("u").alias("k")).collect()}
    for u in urls:
        p = urlparse(u)
        assert got[u] == (p.netloc, p.path.lstrip("/")), u


def test_format_hms(spark):
    secs = [0.0, 59.9, 61.0, 3599.0, 3600.0, 3725.5, 90061.0]
    df = spark.createDataFrame([(s,) for s in secs], "s double")
    got = [r[0] for r in df.select(format_hms("s")).collect()]
    want = [f"{int(s // 3600)}h {int((s % 3600) // 60)}m {int(s % 60)}s" for s in secs]
    assert got == want


def test_random_url_like_strings_match_urlparse(spark):
    import random

    rnd = random.Random(11)
    toks = ["http", "https", "s3a", "HTTP", ":", "//", "/", "///", "?", "#", ";", "@", "[", "]", "a", "B",
            "1", ".", "-", "+", " ", "\t", "\x01", "%20", "x:y", "e.com", "::"]
    urls = sorted({"".join(rnd.choice(toks) for _ in range(rnd.randint(1, 10))) for _ in range(4000)})
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r["u"]: (r["a"], r["k"]) for r in df.select("u", url_authority("u").alias("a"),
                                                            url_key("u").alias("k")).collect()}
    checked = 0
    for u in urls:
        try:
            p = urlparse(u)
        except ValueError:  # Python rejects malformed bracketed hosts; we return the split as written
            continue
        assert got[u] == (p.netloc, p.path.lstrip("/")), repr(u)
        checked += 1
    assert checked > 3000
