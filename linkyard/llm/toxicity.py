"""Toxicity scores over text restored by a noisy channel.

Words that look disguised (any run of digits or signs between letters, a letter three times in a row, a row of
two or more single letters) become character lattices: a sign stands for one of its letters or for nothing, a
repeated letter may be one, separators may vanish.  Viterbi decoding under a character four-gram
model, counted over all training texts, picks the restored word.  A row that becomes a word of two or three letters counts only if
the corpus has that word.  Words and byte six-grams
of the text, and the restored words, then feed a logistic model of the labels.

The label model is fitted on at most ``max_labelled`` labelled rows (one a key, those with the smallest hashes of
it); the character model counts every training text.

Defined results: null and empty texts get the score of a text without any feature; repeated rows
score alike; with no labelled rows (or one class only) every score is the share of label 1 in
them, or 0; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .samples import labelled_rows
from .ship import ship
from .textual import (
    ALNUM, BLOCK, CODES, INV, LOWER, POW, SPACED, doc_blocks, mix64, text_bytes, word_bounds, word_hashes,
)

FEATURE_BITS = 20
GRAM = 6

# Signs and the letters they are written for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "h", "%": "x"}
SEPARATORS = " .-_*~'`,:;/\\"

_CLASS = np.zeros(256, np.int32)  # 0: no letter, 1-26: a-z, 27: a byte of another letter
_CLASS[0x61:0x7B] = _CLASS[0x41:0x5B] = np.arange(1, 27)
_CLASS[0x80:] = 27
CLASSES, ORDER = 28, 4
_LETTER = _CLASS > 0
_LEADS = np.zeros(256, bool)
_LEADS[[ord(c) for c in LEET]] = True
_TRAILS = np.zeros(256, bool)
_TRAILS[[ord(c) for c in "0123456789@$"]] = True
_GRAM_CODES = CODES.copy()
_GRAM_CODES[~ALNUM] = np.uint64(0x2545F4914F6CDD1D)


# --- character model -------------------------------------------------------

SHORT = 27 ** 3  # words of two or three letters a-z


def _short_words(part: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Cells of the words of two or three letters a-z."""
    s, e, _ = word_bounds(part, off, ALNUM)
    size = e - s
    s, size = s[(size == 2) | (size == 3)], size[(size == 2) | (size == 3)]
    c = [_CLASS[part[s]], _CLASS[part[s + 1]], np.where(size == 3, _CLASS[part[np.minimum(s + 2, len(part) - 1)]], 0)]
    plain = (c[0] % 27 > 0) & (c[1] % 27 > 0) & (c[2] < 27) & ((size == 2) | (c[2] > 0))
    return (c[0] * 27 + c[1])[plain] * 27 + c[2][plain]


def corpus_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Over every text: four-gram counts of character classes, as a dense ``CLASSES ** ORDER`` table, and counts of
    the words of two or three letters, as a table of ``SHORT`` cells."""

    def run(batches):
        total = np.zeros(CLASSES ** ORDER + SHORT, np.int64)
        for batch in batches:
            data, off = text_bytes(batch.column(0))
            for lo, hi in doc_blocks(off):
                part = data[off[lo]: off[hi]]
                total[CLASSES ** ORDER:] += np.bincount(_short_words(part, off[lo: hi + 1] - off[lo]), minlength=SHORT)
                for at in range(0, len(part), 2 * BLOCK):
                    c = _CLASS[part[at: at + 2 * BLOCK + ORDER - 1]]
                    n = len(c) - ORDER + 1
                    if n > 0:
                        cell = c[:n]
                        for k in range(1, ORDER):
                            cell = cell * CLASSES + c[k: n + k]
                        total[: CLASSES ** ORDER] += np.bincount(cell, minlength=CLASSES ** ORDER)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["k", "n"])

    out = np.zeros(CLASSES ** ORDER + SHORT, np.int64)
    # At most CLASSES ** ORDER + SHORT rows whatever the corpus.
    rows = docs.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out[rows.column("k").to_numpy()] = rows.column("n").to_numpy()
    return out[: CLASSES ** ORDER], out[CLASSES ** ORDER:]


def character_counts(docs: DataFrame) -> np.ndarray:
    """The four-gram counts of ``corpus_counts``."""
    return corpus_counts(docs)[0]


def character_model(counts: np.ndarray) -> np.ndarray:
    """``log P(d | a, b, c)``, smoothed by a tenth of a count."""
    c = counts.reshape((CLASSES,) * ORDER) + 0.1
    return np.log(c / c.sum(axis=-1, keepdims=True)).astype(np.float32)


# --- lattice decoding ------------------------------------------------------

# Log weights of the channel.  Dropping a sign saves the model's price of a letter, so it costs more
# than any letter does; a separator among letters is dropped at no great cost.
KEEP, SWAP, DROP_SIGN, DROP_SEPARATOR = 0.0, -0.7, -9.0, -0.5
KEEP_DOUBLE, DROP_DOUBLE, KEEP_MORE, DROP_MORE = 0.0, -4.0, -1.5, -0.5  # a letter met twice in a row; in a longer row


def decode(observed: str, model: np.ndarray) -> str:
    """The likeliest plain word behind ``observed`` (lower case)."""
    # state: the last three classes and the last character; value: score and text.
    states = {(0, 0, 0, ""): (0.0, "")}
    for at, c in enumerate(observed):
        again = at > 0 and observed[at - 1] == c
        more = again and (observed[at - 2: at - 1] == c or observed[at + 1: at + 2] == c)
        arcs = []
        if c.isalpha():
            arcs.append((c, (KEEP_MORE if more else KEEP_DOUBLE) if again else KEEP))
            if again:
                arcs.append(("", DROP_MORE if more else DROP_DOUBLE))
        else:
            arcs += [(x, SWAP) for x in LEET.get(c, "")]
            arcs.append(("", DROP_SEPARATOR if c in SEPARATORS else DROP_SIGN))
        nxt: dict = {}
        for (a, b, d, last), (score, text) in states.items():
            for x, cost in arcs:
                if not x:
                    if c.isalpha() and last != c:
                        continue
                    key, value = (a, b, d, last), (score + cost, text)
                else:
                    k = ord(x) - 96 if "a" <= x <= "z" else 27
                    key, value = (b, d, k, x), (score + cost + float(model[a, b, d, k]), text + x)
                if key not in nxt or value[0] > nxt[key][0]:
                    nxt[key] = value
        states = nxt or states
    best = max(((s + float(model[a, b, d, 0]), t) for (a, b, d, _), (s, t) in states.items()), default=(0.0, ""))
    return best[1]


class Restorer:
    """Restored words of text blocks; remembers up to ``keep`` decoded words.

    ``short`` (``SHORT`` cells) are the corpus counts of words of two and three letters: a row of so few single letters
    is taken for a word only if the corpus has that word.
    """

    def __init__(self, model: np.ndarray, short: np.ndarray | None = None, keep: int = 200_000):
        self.model, self.short, self.keep, self.known = model, short, keep, {}

    def is_short_word(self, word: str) -> bool:
        if self.short is None or not (2 <= len(word) <= 3 and word.isascii() and word.isalpha()):
            return False
        a, b, c = [ord(x) - 96 for x in word.ljust(3, "`")]
        return bool(self.short[(a * 27 + b) * 27 + c])

    def word(self, observed: str) -> str:
        if observed not in self.known:
            if len(self.known) >= self.keep:
                self.known.clear()
            # A disguised word is short; of a very long run of signs each stretch is decoded by itself.
            self.known[observed] = "".join(decode(observed[i: i + 64], self.model) for i in range(0, len(observed), 64))
        return self.known[observed]

    def block(self, part: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> list[tuple[int, str]]:
        """``(document, restored word)`` for each word or row of single letters that looks disguised."""
        if not len(starts):
            return []
        low = LOWER[part]
        letter = _LETTER[low]
        sign = ~letter & SPACED[low]
        # A run of signs, however long, with letters on both sides of it: signs between a word's first and last letter.
        at = np.flatnonzero(letter)
        signs = np.concatenate(([0], np.cumsum(sign)))
        one, end = np.searchsorted(at, starts), np.searchsorted(at, ends) - 1
        some = end > one
        among = np.zeros(len(starts), bool)
        among[some] = signs[at[end[some]]] > signs[at[one[some]]]
        marks = np.searchsorted(starts, np.flatnonzero(letter & _repeats(low)), "right") - 1
        size = ends - starts
        first, last = low[starts], low[ends - 1]
        second = low[np.minimum(starts + 1, ends - 1)]
        before = low[np.maximum(ends - 2, starts)]
        flag = (size > 1) & ((_LEADS[first] & _LETTER[second]) | (_TRAILS[last] & _LETTER[before]))
        flag[marks] = True
        flag |= among
        out = []
        for w in np.flatnonzero(flag).tolist():
            seen = low[starts[w]: ends[w]].tobytes().decode("utf-8", "ignore").rstrip(".,!?;:\"')]}")
            if seen and (word := self.word(seen)) != seen:
                out.append((int(doc[w]), word))
        # Rows of one-character words: "a b c d".
        single = (size == 1) & (_LETTER[first] | _LEADS[first])
        edge = np.ones(len(doc) + 1, bool)
        edge[1:-1] = doc[1:] != doc[:-1]
        begin = np.flatnonzero(single & (edge[:-1] | ~np.concatenate(([False], single[:-1]))))
        stop = np.flatnonzero(single & (edge[1:] | ~np.concatenate((single[1:], [False])))) + 1
        for a, b in zip(begin.tolist(), stop.tolist()):
            if b - a < 2:
                continue
            # A word of one letter may stand next to the row: also without its first or last one.
            row = low[starts[a:b]].tobytes().decode("ascii", "ignore")
            words = [self.word(x) for x in (row, row[1:], row[:-1])]
            out += [(int(doc[a]), w) for w in words if len(w) > 3 or self.is_short_word(w)]
        return out


def _repeats(low: np.ndarray) -> np.ndarray:
    out = np.zeros(len(low), bool)
    out[:-2] = (low[:-2] == low[1:-1]) & (low[1:-1] == low[2:])
    return out


# --- features --------------------------------------------------------------

def _feature(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _gram_features(part: np.ndarray) -> np.ndarray:
    """The feature of the six bytes that start at each place but the last five."""
    out = []
    with np.errstate(over="ignore"):
        for at in range(0, max(0, len(part) - GRAM + 1), BLOCK - GRAM):
            seg = part[at: at + BLOCK - 1]
            sums = np.zeros(len(seg) + 1, np.uint64)
            np.cumsum(_GRAM_CODES[seg] * POW[: len(seg)], out=sums[1:])
            n = len(seg) - GRAM + 1
            h = (sums[GRAM:] - sums[:n]) * INV[:n] * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            out.append(_feature(h * np.uint64(0xBF58476D1CE4E5B9))[: BLOCK - GRAM])
    return np.concatenate(out) if out else np.empty(0, np.int64)


def block_features(part: np.ndarray, off: np.ndarray, restorer: Restorer, wanted: np.ndarray | None = None):
    """``(document, feature)`` pairs of a block of texts, each once; only ``wanted`` features if given."""
    s, e, d = word_bounds(part, off, ALNUM)
    words = _feature(word_hashes(part, s, e))
    grams = _gram_features(part)
    at = np.arange(len(grams))
    if wanted is not None:
        keep = wanted[words]
        words, d = words[keep], d[keep]
        at = np.flatnonzero(wanted[grams])
    doc = np.searchsorted(off, at, "right") - 1
    inside = at + GRAM <= off[doc + 1] if len(at) else np.zeros(0, bool)
    ids, docs = [words, grams[at][inside]], [d, doc[inside]]
    ss, se, sd = word_bounds(part, off, SPACED)
    restored = restorer.block(part, ss, se, sd)
    if restored:
        rows = [(i, w) for i, w in restored if w]
        data, o = text_bytes(pa.array([w for _, w in rows], pa.string()))
        rs, re_, rd = word_bounds(data, o, ALNUM)
        f = _feature(word_hashes(data, rs, re_))
        rdoc = np.array([i for i, _ in rows], np.int64)[rd] if rows else np.empty(0, np.int64)
        # The six-grams of a restored word, with blanks around it.
        padded, po = text_bytes(pa.array([f" {w} " for _, w in rows], pa.string()))
        g = _gram_features(padded)
        p = np.arange(len(g))
        pd_ = np.searchsorted(po, p, "right") - 1
        ok = p + GRAM <= po[pd_ + 1] if len(p) else np.zeros(0, bool)
        gdoc = np.array([i for i, _ in rows], np.int64)[pd_[ok]] if rows else np.empty(0, np.int64)
        f, rdoc = np.concatenate((f, g[ok])), np.concatenate((rdoc, gdoc))
        if wanted is not None:
            keep = wanted[f]
            f, rdoc = f[keep], rdoc[keep]
        ids.append(f)
        docs.append(rdoc)
    both = np.unique((np.concatenate(docs).astype(np.int64) << FEATURE_BITS) | np.concatenate(ids))
    return both >> FEATURE_BITS, both & ((1 << FEATURE_BITS) - 1)


# --- label model -----------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """At most ``max_labelled`` rows ``(label, text)``, one per key: those with the smallest key hashes."""
    return labelled_rows(docs, labels, label, max_labelled, key).select("label", "text")


def fit(sample: DataFrame, model: np.ndarray, short: np.ndarray | None = None, n_features: int = 3000, rounds: int = 300, l2: float = 0.2, least_gain: float = 10.0):
    """``(feature ids, weights, bias)`` of a logistic model on the features that tell the labels apart
    best, and by ``least_gain`` nats at least (among a million features, chance alone gives less)."""
    def run(batches):
        restorer = Restorer(model, short)
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for lo, hi in doc_blocks(off):
                doc, ids = block_features(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo], restorer)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                ids = ids.astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["label", "ids"])

    y, n1, n0, docs = [], np.zeros(1 << FEATURE_BITS, np.int32), np.zeros(1 << FEATURE_BITS, np.int32), []
    for r in sample.mapInArrow(run, "label int, ids binary").toLocalIterator():
        ids = np.frombuffer(r["ids"], "<i4")
        (n1 if r["label"] else n0)[ids] += 1
        y.append(r["label"])
        docs.append(ids)
    y = np.array(y, np.float64)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return np.empty(0, np.int64), np.empty(0), (-50.0 if share == 0 else 50.0)
    pos, neg = y.sum(), len(y) - y.sum()
    # The likelihood ratio statistic of presence against label.
    p1, p0, p = (n1 + 0.5) / (pos + 1), (n0 + 0.5) / (neg + 1), (n1 + n0 + 1) / (len(y) + 2)
    gain = n1 * np.log(p1 / p) + n0 * np.log(p0 / p) + (pos - n1) * np.log(np.maximum(1 - p1, 1e-9) / np.maximum(1 - p, 1e-9)) \
        + (neg - n0) * np.log(np.maximum(1 - p0, 1e-9) / np.maximum(1 - p, 1e-9))
    gain[(n1 + n0) < 2] = 0
    chosen = np.argsort(-gain, kind="stable")[:n_features]
    chosen = np.sort(chosen[gain[chosen] >= least_gain])
    rows = np.concatenate([np.full(len(h), i) for i, d in enumerate(docs) if len(h := np.flatnonzero(np.isin(d, chosen)))]
                          or [np.empty(0, np.int64)]).astype(np.int64)
    cols = np.concatenate([np.searchsorted(chosen, d[np.isin(d, chosen)]) for d in docs] or [np.empty(0, np.int64)]).astype(np.int64)
    w, b = np.zeros(len(chosen)), float(np.log(share / (1 - share)))
    # Full-batch gradient steps with per-weight scaling (Adam).
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(rows, w[cols], len(y)) + b
        err = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        g, gb = np.bincount(cols, err[rows], len(w)) + l2 * w, float(err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.05 * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t)
        w -= rate * m / (np.sqrt(v) + 1e-8)
        b -= rate * mb / (np.sqrt(vb) + 1e-8)
    return chosen, w, b


def score_column(text: str, model: np.ndarray, ids: np.ndarray, weights: np.ndarray, bias: float, short: np.ndarray | None = None) -> Column:
    """The toxicity score of a text column."""
    from pyspark.sql import types as T

    def run(texts: pa.Array) -> pa.Array:
        wanted = np.zeros(1 << FEATURE_BITS, bool)
        wanted[ids] = True
        value = np.zeros(1 << FEATURE_BITS)
        value[ids] = weights
        restorer = Restorer(model, short)
        data, off = text_bytes(texts)
        z = np.full(len(off) - 1, bias)
        for lo, hi in doc_blocks(off):
            doc, f = block_features(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo], restorer, wanted)
            z[lo:hi] += np.bincount(doc, value[f], hi - lo)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))), pa.float64())

    return F.arrow_udf(run, T.DoubleType())(text)


def train(docs: DataFrame, labels: DataFrame, training: Callable[[Column], Column] | None = None, max_labelled: int = 8000,
          key: str = "doc_id"):
    """The scorer learned from the rows that ``training`` keeps: a function of a text column's name."""
    ship(docs.sparkSession)
    if training is not None:
        docs, labels = docs.filter(training(F.col(key))), labels.filter(training(F.col(key)))
    counts, short = corpus_counts(docs)
    model = character_model(counts)
    ids, weights, bias = fit(labelled_sample(docs, labels, max_labelled, key), model, short)
    return lambda text: score_column(text, model, ids, weights, bias, short)


def fold(key: Column, folds: int) -> Column:
    """``crc32`` of the key as text, modulo ``folds``; a null key falls in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = 8000) -> DataFrame:
    """Per document: fold, score and verdict; labels are learned from the other folds only."""
    score = train(docs, labels, lambda k: fold(k, 4) != 2, max_labelled)
    return docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), score("text").alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = 8000) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``."""
    score = train(docs, labels, lambda k: fold(k, 4) != 2, max_labelled)
    return docs.filter(score("text") < threshold)
