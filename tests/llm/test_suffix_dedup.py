"""Repeated strings against brute force, with many ranges and long texts."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from linkyard.llm.suffix_dedup import multikey_order, remove_repeats, repeat_report
from linkyard.llm.textual import BLOCK


def brute(rows, length):
    data = [(k, (t or "").encode()) for k, t in rows]
    count = {}
    for _, b in data:
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            count[s] = count.get(s, 0) + 1
    out = []
    for k, b in data:
        covered = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                covered[i + 1:i + 1 + length] = True
        kept = bytes(x for x, c in zip(b, covered[1:]) if not c)
        spans = int((covered[1:] & ~covered[:-1]).sum())
        out.append((k, len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, length, spread, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_repeats(docs, length, spread, **how).collect()
    assert sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in got), key=str) == brute(rows, length)
    for r in got:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["span_from"]) == r["n_spans"]


def _texts(seed, alphabet, n=60):
    rnd = random.Random(seed)
    some = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    passages = [some(rnd.choice([59, 60, 61, 75, 140])) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [some(rnd.randint(0, 90))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randint(0, 12)
            parts += [p[a:] if rnd.random() < 0.4 else p, some(rnd.randint(0, 40))]
        rows.append((i, "".join(parts)))
    whole = rows[0][1] + some(80)
    near = whole[:100] + "#" + whole[101:]
    return rows + [(900 + i, whole) for i in range(4)] + [(910 + i, near[:i] + near[i + 1:]) for i in range(20)] + [
        (950, None), (951, ""), (952, "short"), (None, whole), (None, None), rows[3], (953, whole + whole), (954, "ab" * 90), (955, "a" * 200)]


@pytest.mark.parametrize("seed, alphabet, range_bytes", [(1, "abcdefgh ", 16 << 20), (2, "abcdefgh ", 700), (3, "ab", 900), (4, "aé漢 ", 1500)])
def test_equal_brute_force(spark, seed, alphabet, range_bytes):
    check(spark, _texts(seed, alphabet), 60, 20, range_bytes=range_bytes)


def test_real_length_and_query_columns(spark, no_docs):
    rnd = random.Random(8)
    some = lambda n: "".join(rnd.choice("abcdefghij ") for _ in range(n))
    passage = some(450)
    rows = [(i, some(300) + (passage[: 395 + i] if i % 2 else some(20)) + some(300)) for i in range(16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in repeat_report(docs).collect()), key=str) == brute(rows, 400)
    assert repeat_report(no_docs).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert repeat_report(no_docs).count() == 0


def test_texts_longer_than_a_block(spark):
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, BLOCK + 300_000, np.uint8).tobytes().decode()
    far = text[BLOCK - 700:BLOCK + 800]  # across the border of two pieces
    rows = [(1, text), (2, "x" + far + "y"), (3, text[1000:1700] + "z")]
    got = {r["doc_id"]: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 400, 160).collect()}
    assert (got[1]["span_from"], got[1]["span_to"]) == ([1000, BLOCK - 700], [1700, BLOCK + 800])
    assert (got[2]["span_from"], got[2]["span_to"]) == ([1], [1501])
    assert (got[3]["span_from"], got[3]["span_to"]) == ([0], [700])


def test_multikey_order_is_lexicographic():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 500):
        cols = [rng.integers(0, 5, n).astype(np.uint64) for _ in range(4)]
        order = multikey_order(cols)
        rows = list(zip(*(c[order].tolist() for c in cols)))
        assert rows == sorted(zip(*(c.tolist() for c in cols)))
