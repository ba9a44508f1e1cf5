"""Katz scores against a recursive evaluation over plain counts; distributions sum to one."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from linkyard.llm.katz import DISCOUNTED, SUMS, _packed, _unpacked, discounts, katz_report, katz_scores
from linkyard.llm.toxicity import fold

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
END = b" end "


def tokens(text):
    return WORD.findall((text or "").encode().lower()) + [END]


class Plain:
    """The model again, from counts in dictionaries, asked one token at a time."""

    def __init__(self, texts, vocabulary):
        seqs = [tokens(t) for t in texts]
        self.count = Counter(x for s in seqs for x in s)
        self.n, self.v = sum(self.count.values()), len(self.count)
        ends = self.count.get(END, 0)
        words = {w: c for w, c in self.count.items() if w != END}
        least = max(1, -(-self.n // vocabulary))
        self.vocab = {w for w, c in words.items() if c >= least}
        self.d1 = self._d(words.values())
        self.pair = Counter((a, b) for s in seqs for a, b in zip([None] + [self.unit(x) for x in s], [self.unit(x) for x in s]))
        self.d2 = self._d(self.pair.values())
        self.context = Counter()
        for (a, _), c in self.pair.items():
            self.context[a] += c
        self.p_word = {w: self._cut(self.d1, c) / self.n for w, c in words.items()}
        self.unknown = 1 - sum(self.p_word.values()) - ends / self.n
        self.units = {w: self.p_word[w] for w in self.vocab} | {END: ends / self.n}
        self.units["other"] = 1 - sum(self.units.values())
        self.alpha, self.scale = {}, {}
        for v in self.context:
            seen = [u for a, u in self.pair if a == v]
            kept = sum(self._cut(self.d2, self.pair[v, u]) for u in seen) / self.context[v]
            room = 1 - sum(self.units[u] for u in seen)
            if room <= 1e-9:
                self.alpha[v], self.scale[v] = 0.0, 1 / kept
            else:
                self.scale[v] = self.context[v] / (self.context[v] + 1) if kept > 1 - 1e-9 else 1.0
                self.alpha[v] = (1 - self.scale[v] * kept) / room

    @staticmethod
    def _d(counts):
        n = np.zeros(DISCOUNTED + 2)
        for c in counts:
            if c <= DISCOUNTED + 1:
                n[c] += 1
        return discounts(n)

    @staticmethod
    def _cut(d, c):
        return d[min(c, DISCOUNTED + 1)] * c

    def unit(self, w):
        return w if w == END or w in self.vocab else "other"

    def p_unit(self, u, v):
        if self.pair.get((v, u)):
            return self.scale[v] * self._cut(self.d2, self.pair[v, u]) / self.context[v]
        return self.alpha.get(v, 1.0) * self.units[u]

    def score(self, text):
        out, before = 0.0, None
        for w in tokens(text):
            u = self.unit(w)
            out += math.log10(self.p_unit(u, before))
            if u == "other":
                out += math.log10(self.p_word.get(w, self.unknown) / self.units["other"])
            before = u
        return out

    def base(self, text):
        return sum(math.log10((self.count.get(w, 0) + 1) / (self.n + self.v + 1)) for w in tokens(text))


def _texts(seed, n, vocabulary, most=60):
    rnd = random.Random(seed)
    words = [f"W{i}" for i in range(vocabulary)]
    return [" ".join(words[min(int(rnd.expovariate(6 / vocabulary)), vocabulary - 1)] for _ in range(rnd.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("seed, vocabulary, cached", [(1, 30, 1 << 17), (2, 500, 1 << 17), (3, 500, 40), (4, 3000, 100)])
def test_scores_equal_plain_recursion(spark, seed, vocabulary, cached):
    texts = _texts(seed, 200, vocabulary) + [None, "", "  ", "été ÉTÉ 漢", "W1"]
    fresh = _texts(seed + 50, 30, 2 * vocabulary) + [None, "never seen words", "W1 W1 W1"]
    train = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + fresh)] + [(None, "W1"), (3, texts[3])], "doc_id long, text string")
    plain = Plain(texts, 1 << 60)  # every word a unit of its own
    got = katz_scores(docs.repartition(3), train, cached=cached, hot_pairs=50).collect()
    want = sorted(((str(i), len(tokens(t)), sum(w in plain.count for w in tokens(t)), round(plain.base(t), 6), round(plain.score(t), 6))
                   for i, t in [*enumerate(texts + fresh), (None, "W1"), (3, texts[3])]), key=str)
    assert sorted(((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in got), key=str) == want
    assert {r["train_tokens"] for r in got} == {plain.n}


def test_every_distribution_sums_to_one(spark):
    """Over all words, the end and the unknown word, after every word of training: read off the scores of two-word texts."""
    texts = _texts(9, 60, 12) + ["only"] * 9
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = Plain(texts, 1 << 60)
    words = sorted(w.decode() for w in plain.count if w != END)
    asked = [(v, u) for v in words for u in [*words, "unseen"]] + [(v, None) for v in words]
    docs = spark.createDataFrame([(i, v if u is None else f"{v} {u}") for i, (v, u) in enumerate(asked)], "doc_id long, text string")
    got = {asked[r["doc_id"]]: r["score"] for r in katz_scores(docs, train).collect()}
    end_after = {u: math.log10(plain.p_unit(END, plain.unit(u.encode()))) for u in [*words, "unseen"]}
    for v in words:
        first = math.log10(plain.p_unit(v.encode(), None))
        total = sum(10 ** (got[v, u] - first - end_after[u]) for u in [*words, "unseen"]) + 10 ** (got[v, None] - first)
        assert abs(total - 1) < 1e-9


def test_sums_packed_and_back():
    sums = np.zeros(5, SUMS)
    sums["doc"], sums["known"], sums["base"], sums["score"] = [0, 3, 4, 70_000, 2**32 - 1], [1, 0, 9, 4, 2], np.linspace(-9, 0, 5), np.linspace(-1e6, 1, 5)
    assert [x.tolist() for x in _unpacked(_packed(sums))] == [sums[k].tolist() for k in ("doc", "known", "base", "score")]


def test_report_folds_and_better_than_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = katz_report(docs).collect()
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert all(math.isfinite(r["score"]) for r in rows)
    held = {r["doc_id"] for r in docs.select("doc_id", fold(docs["doc_id"], 7).alias("f")).where("f = 2").collect()}
    assert {r["doc_id"] for r in out} == held


def test_odd_rows_and_empty_tables(spark, odd_docs, odd_rows, no_docs):
    got = katz_report(odd_docs).collect()
    assert len(got) == len(odd_rows) and all(math.isfinite(r["score"]) for r in got)
    assert katz_report(no_docs).count() == 0
    alone = katz_scores(odd_docs, no_docs).collect()
    assert len(alone) == len(odd_rows) and {r["score"] for r in alone} == {0.0} and {r["n_known"] for r in alone} == {0}


def _all_pairs_match(spark, texts, fresh, **how):
    plain = Plain(texts, 1 << 60)  # every word a unit of its own
    train = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + fresh)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in katz_scores(docs.repartition(3), train, **how).collect()}
    assert len(got) == len(texts + fresh)
    for i, t in enumerate(texts + fresh):
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (len(tokens(t)), sum(w in plain.count for w in tokens(t)))
        # Relative: a sum of 138 000 terms depends on their order in the last digits.
        assert (r["base_score"], r["score"]) == (pytest.approx(plain.base(t), rel=1e-9), pytest.approx(plain.score(t), rel=1e-9))


def test_rare_words_keep_their_pairs_in_a_larger_corpus(spark):
    # Over 131 072 tokens: words of one occurrence were once merged into a class.
    texts = _texts(11, 60, 400) + ["a b c a c b " * 23_000] + [None, "", "W1"]
    assert sum(len(tokens(t)) for t in texts) > 1 << 17
    _all_pairs_match(spark, texts, ["W1 never seen", "W399 W398 a", None])


@pytest.mark.parametrize("cached, hot_pairs", [(1 << 17, 1 << 19), (40, 50), (100, 5_000), (1, 1)])
def test_caches_and_buckets_do_not_change_scores(spark, monkeypatch, cached, hot_pairs):
    monkeypatch.setattr("linkyard.llm.katz.PAIR_BUCKET_BYTES", 2_000)
    texts = _texts(12, 200, 500) + [None, "", "  ", "été ÉTÉ 漢"]
    _all_pairs_match(spark, texts, _texts(62, 30, 1000) + ["never seen words", "W1 W1 W1"], cached=cached, hot_pairs=hot_pairs)
