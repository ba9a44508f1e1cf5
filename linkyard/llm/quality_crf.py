"""Quality by line labels of a linear-chain conditional random field.

Every line with a word gets binary features of its shape; a two-state chain (content,
boilerplate) is fitted to lines whose labels come from their document's quality label, by
forward-backward gradients.  Viterbi decoding marks the lines of each whole text, and
a text stays if the words of its content lines are at least ``least_content`` of all its words
and the base rules pass.

The chain is fitted on at most ``max_labelled`` labelled texts (smallest key hashes).

Defined results: null, empty and wordless texts have no lines and fail the base rules (under 10
words); repeated rows get equal results; with labels of one kind only every line is content;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .samples import labelled_rows
from .ship import ship
from .textual import RAW_CODES, SPACED, doc_blocks, find, mix64, per_doc, text_bytes, word_bounds, word_hashes

# The sign characters that are counted.
SIGNS = np.zeros(256, bool)
SIGNS[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_STRONG = np.zeros(256, bool)
_STRONG[[ord(c) for c in "!?"]] = True
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?:;\"'"]] = True
_IS_LINE = np.ones(256, bool)
_IS_LINE[0x0A] = False
_STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80
WINDOW = 5


def _per_span(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of marked bytes in each span."""
    sums = np.zeros(len(mask) + 1, np.int32 if len(mask) < 1 << 31 else np.int64)
    np.cumsum(mask, out=sums[1:])
    return (sums[ends] - sums[starts]).astype(np.int64)


class Block:
    """Words, lines and counts of a block of texts."""

    def __init__(self, part: np.ndarray, off: np.ndarray):
        n = len(off) - 1
        self.n = n
        ws, we, wd = word_bounds(part, off, SPACED)
        self.first_word = per_doc(wd, n)
        self.n_words = np.diff(self.first_word)
        self.word_chars = _per_span(SPACED[part] & _STARTS_CHAR[part], off[:-1], off[1:])
        self.n_symbols = _per_span(SIGNS[part], off[:-1], off[1:])
        h = word_hashes(part, ws, we, RAW_CODES)
        self.n_repeat_words = self._repeats(h, wd, n)
        # Lines with a word, in order.
        ls, le, ld = word_bounds(part, off, _IS_LINE)
        first = np.searchsorted(ws, ls, "left")
        last = np.searchsorted(ws, le, "left")
        has = last > first
        self.ls, self.le, self.doc, self.lw0, self.lw1 = ls[has], le[has], ld[has], first[has], last[has]
        lh = word_hashes(part, self.ls, self.le, RAW_CODES)
        order = np.lexsort((np.arange(len(lh)), lh, self.doc))
        again = np.zeros(len(lh), bool)
        if len(lh):
            again[order[1:]] = (lh[order[1:]] == lh[order[:-1]]) & (self.doc[order[1:]] == self.doc[order[:-1]])
        self.again = again
        self.n_dup_lines = np.bincount(self.doc[again], minlength=n)
        self.first_line = per_doc(self.doc, n)
        self.line_words = self.lw1 - self.lw0
        same = np.zeros(len(h) + 1, bool)
        same[1:-1] = h[1:] == h[:-1]
        self.features = self._features(part, ws, we, same)

    @staticmethod
    def _repeats(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        if len(h) < WINDOW:
            return np.zeros(n, np.int64)
        with np.errstate(over="ignore"):
            m = len(h) - WINDOW + 1
            win = mix64(doc[:m].astype(np.uint64) + np.uint64(1))
            for k in range(WINDOW):
                win = win * np.uint64(0x9E3779B97F4A7C15) + h[k: k + m]
            win = mix64(win)
        at = np.flatnonzero(doc[:m] == doc[WINDOW - 1:])
        win = win[at]
        ordered = np.sort(win)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(twice):
            return np.zeros(n, np.int64)
        hit = at[find(twice, win) >= 0]
        covered = np.zeros(len(h), bool)
        for k in range(WINDOW):
            covered[hit + k] = True
        return np.bincount(doc[covered], minlength=n)

    def _features(self, part, ws, we, same) -> np.ndarray:
        """Binary features of each line, a column each."""
        s, e, words = self.ls, self.le, np.maximum(self.line_words, 1)
        chars = np.maximum(_per_span(SPACED[part], s, e), 1)
        letters = np.maximum(_per_span(_LETTER[part], s, e), 1)
        upper, signs = _per_span(_UPPER[part], s, e) / letters, _per_span(SIGNS[part], s, e) / words
        strong, digits = _per_span(_STRONG[part], s, e) / words, _per_span(_DIGIT[part], s, e) / chars
        pipes = _per_span(part == 0x7C, s, e) / words
        sums = np.concatenate(([0], np.cumsum(same)))
        stutter = (sums[self.lw1] - sums[np.minimum(self.lw0 + 1, self.lw1)]) / words
        # Share of words that are followed by themselves, and of word characters among all.
        width = chars / words
        last = part[we[self.lw1 - 1] - 1] if len(s) else np.empty(0, np.uint8)
        first = part[ws[self.lw0]] if len(s) else np.empty(0, np.uint8)
        cols = [np.ones(len(s), bool), words <= 2, (words > 2) & (words <= 6), (words > 6) & (words <= 15), words > 60,
                upper > 0.3, upper > 0.6, signs > 0.05, signs > 0.3, signs > 0.8, strong > 0.3, strong > 1.0,
                digits > 0.1, digits > 0.4, pipes > 0.2, stutter > 0.1, stutter > 0.5, self.again,
                width < 3, width > 9, _STOPS[last], _UPPER[first], chars / np.maximum(e - s, 1) < 0.6]
        return np.stack(cols, axis=1) if len(s) else np.zeros((0, len(cols)), bool)


N_FEATURES = 23


# --- chain -----------------------------------------------------------------

def _forward_backward(em: np.ndarray, mask: np.ndarray, trans: np.ndarray):
    """Log partition, state and pair marginals of padded sequences ``em[n, t, 2]``."""
    n, t, _ = em.shape
    alpha, beta = np.zeros_like(em), np.zeros_like(em)
    alpha[:, 0] = em[:, 0]
    for i in range(1, t):
        step = np.logaddexp(alpha[:, i - 1, :1] + trans[0], alpha[:, i - 1, 1:] + trans[1]) + em[:, i]
        alpha[:, i] = np.where(mask[:, i, None], step, alpha[:, i - 1])
    z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    for i in range(t - 2, -1, -1):
        nxt = em[:, i + 1] + beta[:, i + 1]
        step = np.logaddexp(trans[:, 0] + nxt[:, :1], trans[:, 1] + nxt[:, 1:])
        beta[:, i] = np.where(mask[:, i + 1, None], step, 0.0)
    state = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
    pairs = np.zeros((2, 2))
    for i in range(1, t):
        p = np.exp(alpha[:, i - 1, :, None] + trans[None] + (em[:, i] + beta[:, i])[:, None, :] - z[:, None, None])
        pairs += (p * mask[:, i, None, None]).sum(axis=0)
    return z, state, pairs


def fit_chain(x: np.ndarray, starts: np.ndarray, y: np.ndarray, rounds: int = 120, l2: float = 1.0, long: int = 256):
    """``(emission weights, transitions)`` from lines ``x`` in sequences that begin at ``starts``, with line
    labels ``y``.  A sequence of over ``long`` lines is fitted as several."""
    cut = sorted({int(v) for a, b in zip(starts[:-1], starts[1:]) for v in range(a, b, long)} | {int(starts[-1])})
    runs = [(a, b) for a, b in zip(cut[:-1], cut[1:]) if b > a]
    runs.sort(key=lambda r: r[1] - r[0])
    groups = [runs[i: i + 400] for i in range(0, len(runs), 400)]
    w, trans = np.zeros((x.shape[1], 2)), np.zeros((2, 2))
    padded = []
    xf = x.astype(np.float64)
    for g in groups:
        t = max(b - a for a, b in g)
        at = np.array([[min(a + i, b - 1) for i in range(t)] for a, b in g])
        mask = np.array([[i < b - a for i in range(t)] for a, b in g])
        padded.append((at, mask))
    truth = np.stack([xf[y == 0].sum(axis=0), xf[y == 1].sum(axis=0)], axis=1)
    pair_truth = np.zeros((2, 2))
    for a, b in runs:
        np.add.at(pair_truth, (y[a: b - 1], y[a + 1: b]), 1)
    mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(trans), np.zeros_like(trans)
    for step in range(1, rounds + 1):
        em = xf @ w
        gw, gt = l2 * w - truth, l2 * trans - pair_truth
        for at, mask in padded:
            _, state, pairs = _forward_backward(em[at], mask, trans)
            p = np.zeros((len(x), 2))
            np.add.at(p, at[mask], state[mask])
            gw = gw + xf.T @ p
            gt = gt + pairs
        mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw * gw
        mt, vt = 0.9 * mt + 0.1 * gt, 0.99 * vt + 0.01 * gt * gt
        rate = 0.1 * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
        w -= rate * mw / (np.sqrt(vw) + 1e-8)
        trans -= rate * mt / (np.sqrt(vt) + 1e-8)
    return w, trans


def viterbi(em: np.ndarray, trans: np.ndarray) -> list[int]:
    """The likeliest states (1: content) of one sequence of line scores."""
    if not len(em):
        return []
    (t00, t01), (t10, t11) = trans.tolist()
    rows = em.tolist()
    a, b = rows[0]
    back = []
    for x, y in rows[1:]:
        from_a, from_b = a + t00 >= b + t10, a + t01 > b + t11
        a, b = (a + t00 if from_a else b + t10) + x, (a + t01 if from_b else b + t11) + y
        back.append((0 if from_a else 1, 0 if from_b else 1))
    out = [0 if a > b else 1]
    for pair in reversed(back):
        out.append(pair[out[-1]])
    return out[::-1]


def train_chain(docs: DataFrame, labels: DataFrame, max_labelled: int = 2000, key: str = "doc_id"):
    """The chain learned from the quality labels of at most ``max_labelled`` texts; None if they are all alike."""
    ship(docs.sparkSession)
    rows = labelled_rows(docs, labels, "quality", max_labelled, key)

    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column(2))
            for lo, hi in doc_blocks(off):
                b = Block(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
                packed = [np.packbits(b.features[i:j], axis=1).tobytes() for i, j in zip(b.first_line[:-1], b.first_line[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(packed, pa.binary())],
                    names=["key", "label", "x"])

    got = sorted((r["key"], r["label"], bytes(r["x"])) for r in rows.mapInArrow(run, "key long, label int, x binary").collect())
    got = [g for g in got if g[2]]
    if len({g[1] for g in got}) < 2:
        return None
    width = -(-N_FEATURES // 8)
    xs = [np.unpackbits(np.frombuffer(g[2], np.uint8).reshape(-1, width), axis=1, count=N_FEATURES) for g in got]
    starts = np.concatenate(([0], np.cumsum([len(x) for x in xs])))
    y = np.repeat([1 if g[1] > 0 else 0 for g in got], [len(x) for x in xs])
    return fit_chain(np.concatenate(xs), starts, y)


RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    *(T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("content_share", T.DoubleType()),
    T.StructField("line_labels", T.StringType()),
])


def line_quality(docs: DataFrame, chain, least_content: float = 0.5) -> DataFrame:
    """Per row the base counts, the label of each line with a word (``C`` content, ``B`` boilerplate, in order),
    the share of words in content lines, and the verdict."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for lo, hi in doc_blocks(off):
                b = Block(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
                if chain is None:
                    state = np.ones(len(b.doc), np.int64)
                else:
                    em = b.features.astype(np.float64) @ chain[0]
                    state = np.array([s for i, j in zip(b.first_line[:-1], b.first_line[1:]) for s in viterbi(em[i:j], chain[1])],
                                     np.int64)
                content = np.bincount(b.doc, state * b.line_words, b.n)
                share = content / np.maximum(b.n_words, 1)
                failed = (b.n_words < 10) | (100 * b.n_repeat_words > 20 * b.n_words)
                letters = np.where(state == 1, "C", "B")
                marks = ["".join(letters[i:j].tolist()) for i, j in zip(b.first_line[:-1], b.first_line[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo),
                     *(pa.array(c.astype(np.int64)) for c in (b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words)),
                     pa.array(failed), pa.array(~failed & (share >= least_content)), pa.array(share), pa.array(marks, pa.string())],
                    names=RESULT.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RESULT)


def quality_report(docs: DataFrame, labels: DataFrame, max_labelled: int = 2000) -> DataFrame:
    """The verdict of every document, with a chain learned from ``labels.quality``."""
    return line_quality(docs, train_chain(docs, labels, max_labelled)).drop("line_labels")
