"""Licence scan: a positional index over licence notices, looked up by each file's rarest licence words.

The notices (templates) are indexed by word: a posting is (template, position).  Document frequencies of
the templates' words are counted over all documents.  Of a file's words that occur in a template the
``ANCHORS`` with the highest inverse document frequency are looked up; a word of the file at place p with a posting at
position q proposes the notice at place p - q.  Proposals are intersected by that relative place: at
least ``AGREE`` anchors (all, if there are fewer) must propose it, up to ``SLACK`` words apart.  A place
counts if every mandatory phrase of the template stands, word by word, within the notice there (and ``SLACK``
words around it).  Its share is the part of the template's words found at their own places, up to
``SLACK`` words off.

Beside that, base phrases are searched everywhere, word by word; their labels always stay, with score 1.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lowered, told apart by 64-bit hashes.  All places of all
templates are checked in a whole text; the work of a batch is numpy over its words and the index, whose
size is that of the templates (a parameter, a few hundred words).

Defined results: a null or empty text has no words, no labels, score 0; ``first_word`` and ``last_word`` are null
without a base place; repeated rows and null keys are rows of their own; an empty table has no row; other columns
are not read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ship import ship
from .textual import ALNUM, doc_blocks, find, per_doc, text_bytes, word_bounds, word_hashes

ANCHORS, AGREE, SLACK = 4, 2, 2

# Base phrases and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Fixed values: (label, notice, mandatory phrases); public notices of common licences, as words.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     ["permission is hereby granted free of charge", "to any person obtaining a copy"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
     ["apache license", "you may not use this file except in compliance with the license"]),
    ("gpl-3", "licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-2", "licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
     "published by the free software foundation either version 3 of the license or at your option any later version",
     ["gnu general public license", "version 3 of the license"]),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
     "published by the free software foundation either version 2 of the license or at your option any later version",
     ["gnu general public license", "version 2 of the license"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ["gnu affero general public license", "version 3"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
     "conditions are met", ["redistribution and use in source and binary forms", "provided that the following conditions are met"]),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission", ["may be used to endorse or promote products", "prior written permission"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial"]),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"]),
    ("cc0", "dedicated to the public domain under the cc0 1 0 universal public domain dedication", ["cc0 1 0 universal"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["distribute this software for any purpose with or without fee"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license v 2 0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]


def hash_words(words: list[str]) -> np.ndarray:
    data, offsets = text_bytes(pa.array([" ".join(words)]))
    starts, ends, _ = word_bounds(data, offsets, ALNUM)
    if len(starts) != len(words):
        raise ValueError(f"not all plain words: {words}")
    return word_hashes(data, starts, ends)


class NoticeIndex:
    """Postings of all templates, their phrases, and the words' document frequencies once they are known."""

    def __init__(self, templates=TEMPLATES, base=None):
        base = BASE_PHRASES if base is None else base
        self.labels = [t[0] for t in templates]
        notices = [t[1].split() for t in templates]
        self.must = [[tuple(p.split()) for p in t[2]] for t in templates]
        self.base = {tuple(k.split()): v for k, v in base.items()}
        self.phrases = sorted({p for m in self.must for p in m} | set(self.base))
        words = sorted({w for n in notices for w in n} | {w for p in self.phrases for w in p})
        hashes = hash_words(words)
        order = np.argsort(hashes)
        self.keys = hashes[order]                                     # sorted; a word's number is its place here
        number = {words[j]: i for i, j in enumerate(order)}
        self.notices = [np.array([number[w] for w in n]) for n in notices]
        self.phrase_words = {p: np.array([number[w] for w in p]) for p in self.phrases}
        self.postings = []                                            # per template: word number -> positions
        for n in self.notices:
            at = defaultdict(list)
            for q, w in enumerate(n):
                at[int(w)].append(q)
            self.postings.append(dict(at))
        self.longest = max([len(n) for n in self.notices] + [len(p) for p in self.phrases])
        self.rank = None                                              # by inverse document frequency, rarest first

    def with_frequencies(self, counts: dict[int, int]) -> NoticeIndex:
        """Rank words by ascending document frequency (descending IDF), ties by their hash."""
        df = np.array([counts.get(i, 0) for i in range(len(self.keys))])
        self.rank = np.empty(len(df), np.int64)
        self.rank[np.argsort(df, kind="stable")] = np.arange(len(df))
        return self


def _near(sorted_at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether some value of ``sorted_at`` lies in each ``[lo, hi]``."""
    return np.searchsorted(sorted_at, hi, "right") > np.searchsorted(sorted_at, lo, "left")


def _phrase_places(word: np.ndarray, place: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Places where the words of ``phrase`` stand one after the other; ``word`` by ascending ``place``."""
    n = len(phrase)
    if len(word) < n:
        return np.empty(0, np.int64)
    m = word[: len(word) - n + 1] == phrase[0]
    for i in range(1, n):
        m &= (word[i: len(word) - n + 1 + i] == phrase[i]) & (place[i: len(word) - n + 1 + i] == place[: len(word) - n + 1] + i)
    return place[: len(word) - n + 1][m]


def _anchors(doc: np.ndarray, rank: np.ndarray, n: int) -> np.ndarray:
    """Marks the occurrences of each document's ``n`` words of lowest rank, 0 to n-1 by rank; -1 elsewhere."""
    pairs = np.unique(doc * (1 << 32) + rank)
    d = pairs >> 32
    nth = np.arange(len(pairs)) - np.searchsorted(d, d, "left")
    at = nth[np.searchsorted(pairs, doc * (1 << 32) + rank)]
    return np.where(at < n, at, -1)


def notice_places(index: NoticeIndex, t: int, word, place, doc, phrase_at, by_word) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(doc, place, share)`` of the verified places of template ``t``, by document and place."""
    empty = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    if any(not len(phrase_at[p]) for p in index.must[t]):
        return empty
    notice, postings = index.notices[t], index.postings[t]
    own = np.isin(word, notice)
    w, p, d = word[own], place[own], doc[own]
    nth = _anchors(d, index.rank[w], ANCHORS)
    w, p, d, nth = (x[nth >= 0] for x in (w, p, d, nth))
    # One proposal per occurrence of an anchor and posting of its word.
    times = np.array([len(postings.get(k, ())) for k in range(len(index.keys))])[w]
    which = np.repeat(np.arange(len(w)), times)
    turn = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    flat = np.concatenate([postings.get(k, []) for k in range(len(index.keys))]).astype(np.int64)
    head = np.cumsum([0] + [len(postings.get(k, ())) for k in range(len(index.keys))])
    at = p[which] - flat[head[w[which]] + turn]
    by, of = nth[which], d[which]
    votes = np.zeros(len(at), np.int64)
    for r in range(ANCHORS):
        mine = np.sort(at[by == r])
        votes += _near(mine, at - SLACK, at + SLACK)
    # Fewer anchors than AGREE in a file: all of them must agree.
    count = np.zeros(int(d.max()) + 1 if len(d) else 1, np.int64)
    np.maximum.at(count, d, nth + 1)
    good = votes >= np.minimum(AGREE, count[of])
    at, of = at[good], of[good]
    for phrase in index.must[t]:
        ok = _near(phrase_at[phrase], at - SLACK, at + len(notice) + SLACK - len(phrase))
        at, of = at[ok], of[ok]
    if not len(at):
        return empty
    at, first = np.unique(at, return_index=True)
    of = of[first]
    found = np.zeros(len(at))
    for i, k in enumerate(notice):
        found += _near(by_word[int(k)], at + i - SLACK, at + i + SLACK)
    return of, at, found / len(notice)


OUT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("notices", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("template", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("share", T.DoubleType())]))),
])


def _known_words(index: NoticeIndex, data, offsets):
    """``(word, place, doc, words per document, gap)`` of the texts: numbers of the index's words; places count the words
    of all texts, with a gap between texts that no notice spans."""
    starts, ends, doc = word_bounds(data, offsets, ALNUM)
    n_docs, gap = len(offsets) - 1, index.longest + 2 * SLACK + 1
    word = find(index.keys, word_hashes(data, starts, ends))
    first = per_doc(doc, n_docs)
    known = np.flatnonzero(word >= 0)
    return word[known], known + doc[known] * gap, doc[known], first, gap


def _scan(index: NoticeIndex, data, offsets) -> list[tuple]:
    word, place, doc, first, gap = _known_words(index, data, offsets)
    n_docs = len(offsets) - 1
    start_of = first[:-1] + np.arange(n_docs) * gap
    order = np.argsort(word, kind="stable")
    cut = np.searchsorted(word[order], np.arange(len(index.keys) + 1))
    by_word = [place[order[cut[k]: cut[k + 1]]] for k in range(len(index.keys))]
    phrase_at = {p: _phrase_places(word, place, index.phrase_words[p]) for p in index.phrases}
    base = [[] for _ in range(n_docs)]
    for phrase, label in index.base.items():
        for at in phrase_at[phrase]:
            d = int(np.searchsorted(start_of, at, "right")) - 1
            base[d].append((int(at - start_of[d]), label))
    notices = [[] for _ in range(n_docs)]
    for t, label in enumerate(index.labels):
        for d, at, share in zip(*notice_places(index, t, word, place, doc, phrase_at, by_word)):
            notices[d].append((label, t, int(at - start_of[d]), float(share)))
    out = []
    for d in range(n_docs):
        places = sorted(x for x, _ in base[d])
        own = sorted({label for _, label in base[d]})
        all_labels = sorted(set(own) | {x[0] for x in notices[d]})
        score = 1.0 if own else max([x[3] for x in notices[d]], default=0.0)
        out.append((int(first[d + 1] - first[d]), len(places), places[0] if places else None, places[-1] if places else None,
                    ",".join(own), ",".join(all_labels), score, sorted(notices[d], key=lambda x: (x[2], x[1]))))
    return out


def _count_words(index: NoticeIndex):
    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            total = np.zeros(len(index.keys), np.int64)
            for lo, hi in doc_blocks(offsets):
                part = offsets[lo: hi + 1]
                word, _, doc, _, _ = _known_words(index, data[part[0]: part[-1]], part - part[0])
                total += np.bincount(np.unique(doc * len(index.keys) + word) % len(index.keys), minlength=len(index.keys))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["word", "n"])
    return run


def _scan_batches(index: NoticeIndex):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
             pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("start", pa.int64()), ("share", pa.float64())]))]

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in doc_blocks(offsets):
                part = offsets[lo: hi + 1]
                rows = _scan(index, data[part[0]: part[-1]], part - part[0])
                cols = list(zip(*rows))
                cols[-1] = [[dict(zip(("label", "template", "start", "share"), x)) for x in r] for r in cols[-1]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo)] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=OUT.names)
    return run


def document_frequencies(documents: DataFrame, index: NoticeIndex) -> dict[int, int]:
    """In how many documents each word of the index occurs: one row per word of the index."""
    ship(documents.sparkSession)
    counts = documents.select("text").mapInArrow(_count_words(index), "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in counts.collect()}


def licence_scan(documents: DataFrame, templates=TEMPLATES, base_phrases=None) -> DataFrame:
    """Per document: doc_id, n_words, the base phrases' places (n_base, first_word, last_word, base_labels), all
    labels, a score (1 with a base phrase, else the best notice's share) and the notices found:
    label, number of the template, start word (below 0 if the text begins inside the notice) and share."""
    ship(documents.sparkSession)
    index = NoticeIndex(templates, base_phrases)
    index.with_frequencies(document_frequencies(documents, index))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan_batches(index), OUT)
