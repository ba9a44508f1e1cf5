from __future__ import annotations

import random

import pytest

EXTRA = "fp string, u long, shard string, key string, slice string, addr string, bucket string, label string, tokens string"


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): nulls everywhere, empty, blank, long, repeated and Unicode texts."""
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "delta.", "été", "Straße", "漢字", "x", "7", "***", "😀", "naïve"]
    base = " ".join(rnd.choice(words) for _ in range(60))
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\r\n ", "en", "a"), (4, "one", "en", None), (5, base, "en", "b"),
        (5, base, "en", "b"), (6, base, "fr", "a"), (None, base + " tail", None, "c"), (None, None, None, None),
        (7, "line one\nline two\n\nline one\r\nlast\x0bline\x0cend\x1cmore\u00a0hard\u3000space", "de", "b"),
        (8, " ".join(rnd.choice(words) for _ in range(30_000)), "en", "a"),
        (9, "  lead  and   trail  ", "es", "Z"), (10, "\x00 nul \x00", "es", "é"), (11, "!?., ,. .,", "es", "a"),
    ]
    rows += [(20 + i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 80))), rnd.choice(["en", "fr"]), rnd.choice("abc"))
             for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """``odd_rows`` with columns whose names the operators use inside."""
    n = len(EXTRA.split(","))
    return spark.createDataFrame([(*r, 0, *([None] * n)) for r in odd_rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
