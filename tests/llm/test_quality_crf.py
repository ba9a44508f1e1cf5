"""Line labels: Viterbi and forward-backward against enumeration, base counts by brute force."""

from __future__ import annotations

import re
from collections import Counter
from itertools import product

import numpy as np

from linkyard.llm.quality_crf import _forward_backward, fit_chain, line_quality, quality_report, train_chain, viterbi

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_chain_equals_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        em, trans = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        score = {p: sum(em[i, s] for i, s in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:])) for p in product((0, 1), repeat=n)}
        assert tuple(viterbi(em, trans)) == max(score, key=score.get)
        z, state, pairs = _forward_backward(em[None], np.ones((1, n), bool), trans)
        total = sum(np.exp(v) for v in score.values())
        assert np.isclose(z[0], np.log(total))
        for i in range(n):
            assert np.isclose(state[0, i, 1], sum(np.exp(v) for p, v in score.items() if p[i]) / total)
        assert np.isclose(pairs.sum(), n - 1)


def test_fit_learns_a_separable_chain():
    rng = np.random.default_rng(3)
    y = np.repeat(rng.integers(0, 2, 60), 5)
    x = np.stack([np.ones(300, bool), y == 1, rng.random(300) < 0.5], axis=1)
    w, trans = fit_chain(x, np.arange(0, 301, 10), y)
    assert viterbi(x.astype(float) @ w, trans) == y.tolist()


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = sorted((tuple(r[c] for c in ("doc_id", *COLS)) for r in line_quality(odd_docs, None).collect()), key=str)
    assert got == sorted(((r[0], *base(r[1])) for r in odd_rows), key=str)
    assert all(r["kept"] == (not r["base_failed"]) for r in line_quality(odd_docs, None).collect())
    assert line_quality(no_docs, None).count() == 0


def test_labels_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_report(docs, labels).join(labels, "doc_id").collect()
    passed = [r for r in rows if not r["base_failed"]]
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in passed]) > 0.97
    assert train_chain(docs, labels.where("quality = 1")) is None


def test_lines_are_marked_one_by_one(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    clean = next(r["text"] for r in docs.join(labels.where("quality = 1 and toxic = 0"), "doc_id").orderBy("doc_id").collect()
                 if r["text"].count("\n") >= 3)
    junk = "\n".join("BUY!! NOW!! CLICK!! HERE!! %%% ### $$$ ***" for _ in range(4))
    one = spark.createDataFrame([(1, clean + "\n" + junk)], "doc_id long, text string")
    marks = line_quality(one, train_chain(docs, labels)).first()["line_labels"]
    assert marks.endswith("BBBB") and marks.startswith("CC")
