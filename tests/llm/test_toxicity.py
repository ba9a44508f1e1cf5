"""Noisy-channel restoration and held-out accuracy."""

from __future__ import annotations

import numpy as np
import pytest

from linkyard.llm.textual import CODES, SPACED, text_bytes, word_bounds
from linkyard.llm.samples import labelled_rows, one_of_each
from linkyard.llm.toxicity import (
    CLASSES, FEATURE_BITS, GRAM, Restorer, block_features, character_counts, character_model, corpus_counts, decode, drop_toxic, fit, fold,
    labelled_sample, toxicity_scores, train,
)

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return character_model(character_counts(spark.read.parquet(f"{SF}/documents.parquet")))


def test_counts_equal_brute_force(spark):
    texts = ["ab", "abc ABC", "é1", None, ""]
    counts = character_counts(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1))
    cls = [27 if b >= 128 else (b | 32) - 96 if chr(b).isalpha() else 0 for b in "".join(t or "" for t in texts).encode()]
    want = np.zeros((CLASSES,) * 4, int)
    for four in zip(cls, cls[1:], cls[2:], cls[3:]):
        want[four] += 1
    assert counts.tolist() == want.reshape(-1).tolist()


def test_disguised_words_are_restored(model):
    for seen, word in (("1d10t", "idiot"), ("m0r0n", "moron"), ("stup1d", "stupid"), ("p@th3tic", "pathetic"), ("id.i.ot", "idiot"),
                       ("l-o-s-e-r", "loser"), ("idioooot", "idiot"), ("tr@sh", "trash"), ("$cum", "scum")):
        assert decode(seen, model) == word
    assert decode("plain", model) == "plain" and decode("", model) == ""


def test_what_looks_disguised(model):
    data = np.frombuffer("You 1d10t! a m o r o n here, clown*** 4.0 trash".encode(), np.uint8)
    found = Restorer(model).block(data, *word_bounds(data, np.array([0, len(data)]), SPACED))
    assert {w for _, w in found} >= {"idiot"} and any("moron" in w for _, w in found)
    assert not any("clown" in w or w == "trash" for _, w in found)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    toxic, clean = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    assert np.mean([r["predicted"] for r in toxic]) > 0.8 and np.mean([r["predicted"] for r in clean]) < 0.02


def test_disguise_does_not_help(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    clean = docs.join(labels.where("toxic = 0 and quality = 1"), "doc_id").where("lang = 'en'").orderBy("doc_id").limit(20).collect()
    hidden = ["1d10t m0r0n", "w0rthless tr@sh", "p@thetic cl0wn", "i d i o t and m.o.r.o.n", "stuuupid $cum l0ser"]
    rows = [(i, r["text"] + " " + hidden[i % 5]) for i, r in enumerate(clean)] + [(100 + i, r["text"]) for i, r in enumerate(clean)]
    test = spark.createDataFrame(rows, "doc_id long, text string")
    score = train(docs, labels)
    got = {r["doc_id"]: r["s"] for r in test.select("doc_id", score("text").alias("s")).collect()}
    assert np.mean([got[i] >= 0.3 for i in range(20)]) >= 0.9
    assert sum(got[100 + i] >= 0.3 for i in range(20)) <= 1


def test_odd_rows_and_empty_tables(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(r[0], 1, int(i % 3 == 0)) for i, r in enumerate(odd_rows)] + [(5, 0, None), (999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity_scores(odd_docs, labels).collect()
    assert len(got) == len(odd_rows)
    one = {r["doc_id"]: r["score"] for r in got if r["doc_id"] in (1, 2)}
    assert one[1] == one[2]
    none = labels.where("false")
    assert {r["predicted"] for r in toxicity_scores(odd_docs, none).collect()} == {0}
    assert toxicity_scores(no_docs, labels).count() == 0
    kept = drop_toxic(odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == len(odd_rows)


def test_fold_is_crc32_of_the_key_as_text(spark):
    import zlib

    ids = spark.range(50)
    got = [(r["id"], r["f"]) for r in ids.select("id", fold(ids["id"], 4).alias("f")).collect()]
    assert got == [(i, zlib.crc32(str(i).encode()) % 4) for i in range(50)]


def test_short_rows_and_long_runs_of_signs(spark):
    """Rows of two and three single letters become words that the corpus has; any run of signs between letters counts."""
    corpus = ["the xyz is an idiot of old, xyz no moron"] * 50
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "doc_id long, text string")
    counts, short = corpus_counts(docs)
    assert short[(24 * 27 + 25) * 27 + 26] == 100 and short[(1 * 27 + 14) * 27] == 50 and short.sum() == 50 * 8  # twice xyz; the, is, an, of, old, no
    restorer = Restorer(character_model(counts), short)

    def found(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return [w for _, w in restorer.block(data, *word_bounds(data, np.array([0, len(data)]), SPACED))]

    assert found("see x y z there") == ["xyz"] and found("a n old") == ["an"] and found("go q y z") == []
    assert found("id.....iot") == ["idiot"] and found("m-_-_-_-oron") == ["moron"] and found("plain -- words") == []


def plain_features(text, restorer):
    """The features of one text by plain loops over its bytes."""
    codes, mask = [int(c) for c in CODES], (1 << 64) - 1
    base = 0x9E3779B97F4A7C15 | 1

    def mix(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & mask
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    def words_and_grams(raw):
        out, word = set(), []
        alnum = [0x30 <= b < 0x3A or 0x41 <= b < 0x5B or 0x61 <= b < 0x7B or b >= 0x80 for b in raw]
        for b, ok in zip([*raw, 0], [*alnum, False]):
            if ok:
                word.append(b)
            elif word:
                out.add(mix(sum(codes[c] * pow(base, i, 1 << 64) for i, c in enumerate(word)) & mask) >> (64 - FEATURE_BITS))
                word = []
        for i in range(len(raw) - GRAM + 1):
            h = sum((codes[b] if ok else 0x2545F4914F6CDD1D) * pow(base, k, 1 << 64) for k, (b, ok) in enumerate(zip(raw[i: i + GRAM], alnum[i: i + GRAM]))) & mask
            h = h * 0x9E3779B97F4A7C15 & mask
            h ^= h >> 29
            out.add((h * 0xBF58476D1CE4E5B9 & mask) >> (64 - FEATURE_BITS))
        return out

    raw = text.encode()
    out = words_and_grams(raw)
    data = np.frombuffer(raw, np.uint8)
    for _, w in restorer.block(data, *word_bounds(data, np.array([0, len(data)]), SPACED)):
        if w:
            padded = f" {w} ".encode()
            out |= words_and_grams(w.encode()) | words_and_grams(padded)
    return out


def test_features_against_plain_loops(model, odd_rows):
    import pyarrow as pa

    texts = [r[1] or "" for r in odd_rows if len(r[1] or "") < 2000] + ["You 1d10t, i d i o t! m.o.r.o.n", "aa bb cc", "é1 $cum"]
    doc, ids = block_features(*text_bytes(pa.array(texts)), Restorer(model))
    for i, t in enumerate(texts):
        assert set(ids[doc == i].tolist()) == plain_features(t, Restorer(model))


def test_scores_against_plain_sums(spark):
    """Every score is the logistic of the summed weights of the text's own features."""
    import pyarrow as pa

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    own = docs.filter(fold(docs["doc_id"], 4) != 2)
    counts, short = corpus_counts(own)
    ids, weights, bias = fit(labelled_sample(own, labels.filter(fold(labels["doc_id"], 4) != 2), 8000), character_model(counts), short)
    value = dict(zip(ids.tolist(), weights.tolist()))
    got = {r["doc_id"]: r for r in toxicity_scores(docs, labels).collect()}
    restorer = Restorer(character_model(counts), short)
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    assert len(rows) == len(got)
    for r in rows:
        _, features = block_features(*text_bytes(pa.array([r["text"]])), restorer)
        want = 1 / (1 + np.exp(-(bias + sum(value.get(f, 0.0) for f in features.tolist()))))
        assert abs(got[r["doc_id"]]["score"] - want) < 1e-9 and got[r["doc_id"]]["predicted"] == int(want >= 0.3)


def test_samples_stay_bounded_when_a_key_repeats(spark):
    rows = [(7, f"text {i % 40}", "en") for i in range(3000)] + [(i, f"own {i}", "fr") for i in range(100, 160)] + [(None, "no key", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(7, 1)] * 500 + [(i, i % 2) for i in range(100, 160)] + [(None, 1)], "doc_id long, toxic int")
    some = labelled_rows(docs, labels, "toxic", 10).collect()
    assert len(some) == 10 and len({r["key"] for r in some}) == 10
    assert len(labelled_rows(docs, labels, "toxic", 1000).collect()) == 61
    langs = one_of_each(docs, ["doc_id", "lang"], ["text"], 10).collect()
    assert len(langs) == 10 and one_of_each(docs, ["doc_id", "lang"], ["text"], 1000).count() == 62


def test_columns_of_the_user_stay(spark, odd_docs):
    labels = spark.createDataFrame([(5, 0), (6, 1)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    docs = odd_docs.withColumn("_tx_score", F.lit("mine"))
    assert {r["_tx_score"] for r in drop_toxic(docs, labels.where("false")).collect()} == {"mine"}
