"""Suffix automaton against windows found by brute force; spans removed from texts."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkyard.llm.decontaminate import SuffixAutomaton, contamination, remove_benchmark

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    grams = {}
    for n, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            grams.setdefault(tuple(w[i:i + window]), set()).add(n)
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if names := grams.get(tuple(w[i:i + m])):
                    hit |= set(range(i, i + m))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def _case(seed, vocabulary, n_docs=40, n_items=25):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)] + ["É", "漢"]
    some = lambda n: " ".join(rnd.choice(vocab).upper() if rnd.random() < 0.1 else rnd.choice(vocab) + rnd.choice(["", ".", "--"])
                              for _ in range(n))
    items = [(i, some(rnd.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(n_items)] + [(77, None), (78, " .,"), (3, some(12))]
    docs = [(i, some(rnd.randint(0, 120)) + " " + (items[i % len(items)][1] or "") + " " + some(rnd.randint(0, 9))) for i in range(n_docs)]
    return docs + [(900, None), (901, ""), docs[0], (None, docs[1][1])], items


@pytest.mark.parametrize("vocabulary, block_words", [(3, 10**6), (40, 10**6), (40, 30), (400, 50)])
def test_windows_equal_brute_force(spark, vocabulary, block_words):
    docs, items = _case(vocabulary, vocabulary)
    d = spark.createDataFrame([(*x, "s", "s") for x in docs], "doc_id long, text string, items string, words string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in contamination(d, b, block_words=block_words).collect()), key=str)
    assert got == brute(docs, items)


def test_odd_rows_and_empty_tables(spark, odd_docs, odd_rows, no_docs):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    none = spark.createDataFrame([], "item_id long, text string")
    got = sorted((tuple(r) for r in contamination(odd_docs, none).collect()), key=str)
    assert got == brute([(r[0], r[1]) for r in odd_rows], [])
    assert contamination(no_docs, bench).count() == 0 and remove_benchmark(no_docs, bench).count() == 0
    kept = remove_benchmark(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == sorted((str(r[0]), str(r[1])) for r in odd_rows)


def test_removal_leaves_no_window_and_clean_texts_alone(spark):
    docs, items = _case(7, 300, 60)
    items = [(n, t) for n, t in items if t is None or len(words(t)) >= 9]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    before = {r[0]: r for r in brute(docs, items)}
    kept = remove_benchmark(d, b).collect()
    texts = dict(docs)
    for r in kept:
        if not before[r["doc_id"]][5]:
            assert r["text"] == texts[r["doc_id"]]
        else:
            assert len(words(r["text"])) == before[r["doc_id"]][1] - before[r["doc_id"]][2]
    assert not any(x[5] for x in brute([(r["doc_id"], r["text"]) for r in kept], items))
    gone = set(before) - {r["doc_id"] for r in kept}
    assert all(before[g][2] > 0.8 * before[g][1] for g in gone)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=8), max_size=5), st.lists(st.integers(0, 3), max_size=25))
def test_automaton_hits(items, text):
    sam = SuffixAutomaton(3).build(list(enumerate(items)))
    want = set()
    for n, w in enumerate(items):
        for i in range(max(1, len(w) - 2)) if w else ():
            g = w[i:i + 3]
            want |= {(e, len(g), n) for e in range(len(g), len(text) + 1) if text[e - len(g):e] == g}
    assert set(sam.hits(text)) == want
