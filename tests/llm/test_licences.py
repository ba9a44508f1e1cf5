from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkyard.llm.licences import AGREE, ANCHORS, BASE_PHRASES, SLACK, TEMPLATES, NoticeIndex, document_frequencies, hash_words, licence_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(words, phrase):
    p = phrase.split()
    return [i for i in range(len(words) - len(p) + 1) if words[i: i + len(p)] == p]


def ranks(texts):
    """Template words, rarest first; ties by hash."""
    vocabulary = sorted({w for _, n, must in TEMPLATES for p in [n, *must] for w in p.split()} | {w for p in BASE_PHRASES for w in p.split()})
    df = Counter(w for t in texts for w in set(words_of(t)))
    keys = dict(zip(vocabulary, hash_words(vocabulary)))
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (df[w], keys[w])))}


def brute(text, rank):
    words = words_of(text)
    base = sorted((i, label) for p, label in BASE_PHRASES.items() for i in places(words, p))
    found = []
    for t, (label, notice, must) in enumerate(TEMPLATES):
        n = notice.split()
        anchors = sorted(set(n) & set(words), key=rank.get)[:ANCHORS]
        proposals = {a: sorted({p - q for p, w in enumerate(words) if w == a for q, x in enumerate(n) if x == a}) for a in anchors}
        for o in sorted({o for v in proposals.values() for o in v}):
            if sum(any(abs(o - x) <= SLACK for x in v) for v in proposals.values()) < min(AGREE, len(anchors)):
                continue
            if all(any(o - SLACK <= s <= o + len(n) + SLACK - len(p.split()) for s in places(words, p)) for p in must):
                share = sum(any(0 <= o + i + e < len(words) and words[o + i + e] == w for e in range(-SLACK, SLACK + 1)) for i, w in enumerate(n)) / len(n)
                found.append((label, t, o, share))
    own = sorted({x for _, x in base})
    return (len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(own),
            ",".join(sorted(set(own) | {x[0] for x in found})), 1.0 if own else max([x[3] for x in found], default=0.0),
            sorted((x[2], x[1], x[0], round(x[3], 9)) for x in found))


def got(df):
    return sorted(((r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score,
                               sorted((x.start, x.template, x.label, round(x.share, 9)) for x in r.notices))) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def noted_rows():
    rnd = random.Random(3)
    filler = "alpha beta license version of the and under cc by public software 2 3 gnu permission granted copy general".split()
    rows = []
    for i in range(120):
        parts = [rnd.choice(filler) for _ in range(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 3)):
            label, notice, _ = rnd.choice(TEMPLATES)
            n = notice.split()
            kind = rnd.random()
            if kind < .3:
                n = [w for w in n if rnd.random() < .85]
            elif kind < .5:
                n.insert(rnd.randrange(len(n)), "inserted")
            elif kind < .6:
                n = n[rnd.randrange(4):]
            at = rnd.randint(0, len(parts))
            parts[at:at] = n
        text = rnd.choice([" ", ", ", "\n"]).join(w.upper() if rnd.random() < .2 else w for w in parts)
        rows.append((1000 + i, text))
    rows += [(2000, "Under the MIT License"), (2000, "Under the MIT License"), (2001, "mit license"), (2002, "Apache License, Version 2.0"),
             (2003, "apache license version 20"), (2004, "CC BY-NC"), (2005, "cc by"), (2006, "nc under the"), (2007, "mit license cc"), (2008, "by nc"),
             (2009, "This work is licensed under the GNU General Public License, version 3."), (None, "licensed under cc by nc 4 0")]
    return rows


def test_notices_against_brute_force(spark, odd_docs, odd_rows, noted_rows):
    docs = odd_docs.select("doc_id", "text", "label", "tokens").unionByName(spark.createDataFrame(noted_rows, "doc_id long, text string"),
                                                                          allowMissingColumns=True).withColumn("word", F.lit(1))
    rows = [(r[0], r[1]) for r in odd_rows] + noted_rows
    rank = ranks([t for _, t in rows])
    want = sorted(((d, brute(t, rank)) for d, t in rows), key=str)
    assert got(licence_scan(docs.repartition(3))) == want
    assert sum(bool(w[1][5]) for w in want) > 60 and any(w[1][5] != w[1][4] for w in want)


def test_notice_with_words_in_between_and_partial():
    index = NoticeIndex().with_frequencies({})
    from linkyard.llm.licences import _scan
    from linkyard.llm.textual import text_bytes

    def labels(text):
        return _scan(index, *text_bytes(pa.array([text])))[0][5]

    assert labels("x This work is licensed under the GNU General Public License, version 3. y") == "gpl-3"
    assert labels("the GNU General Public Library, version 3") == ""  # a mandatory phrase is missing
    assert labels("general public license " + "pad " * 50 + "gnu version 3") == ""  # words far apart
    assert labels("Permission is hereby granted, free of charge, to any person obtaining a copy of this thing") == "mit"


def test_frequencies_count_documents_once(spark, noted_rows):
    docs = spark.createDataFrame(noted_rows, "doc_id long, text string").repartition(5)
    index = NoticeIndex()
    counts = document_frequencies(docs, index)
    for w in ("mit", "license", "gnu", "nc"):
        k = int((index.keys == hash_words([w])[0]).argmax())
        assert counts.get(k, 0) == sum(w in words_of(t) for _, t in noted_rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rank = ranks([t for _, t in rows])
    assert got(licence_scan(docs)) == sorted(((d, brute(t, rank)) for d, t in rows), key=str)


def test_empty(spark, no_docs):
    assert licence_scan(no_docs).count() == 0
