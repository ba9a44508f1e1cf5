"""Language identification by error-correcting output codes.

Every language has a codeword of +1/-1 bits (the exhaustive code up to seven languages, a
seeded random code with the best least distance above).  A binary logistic classifier over
hashed byte n-grams predicts each bit; decoding sums each codeword's logistic losses, every bit
weighted by how well it did for that language in training, and takes the language of
least loss.  The score is that language's share of ``exp(-loss)``; a small lead over the next
codeword marks the row ambiguous.

Classifiers are fitted on at most ``max_labelled`` labelled texts (smallest key hashes).

Defined results: null texts, and texts without a letter, are ``und`` with score 0; with no labelled
texts all are; repeated rows get equal results; source and labels are never read in a prediction.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .samples import one_of_each
from .ship import ship
from .textual import ALNUM, BLOCK, CODES, INV, POW, doc_blocks, text_bytes
from .toxicity import fold

DIMS = 4096
ORDERS = (1, 2, 3, 4)
_WORDS = ALNUM.copy()
_WORDS[0x30:0x3A] = False
_GRAM_CODES = CODES.copy()
_GRAM_CODES[~_WORDS] = np.uint64(0x2545F4914F6CDD1D)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True


def block_vectors(part: np.ndarray, off: np.ndarray) -> np.ndarray:
    """For each text of a block, the square roots of its n-grams' shares, hashed to ``DIMS``."""
    n = len(off) - 1
    out = np.zeros((n, DIMS), np.float32)
    with np.errstate(over="ignore"):
        for at in range(0, len(part), BLOCK // 2):
            seg = part[at: at + BLOCK // 2 + max(ORDERS) - 1]
            own = min(len(seg), BLOCK // 2)
            sums = np.zeros(len(seg) + 1, np.uint64)
            np.cumsum(_GRAM_CODES[seg] * POW[: len(seg)], out=sums[1:])
            doc = np.searchsorted(off, np.arange(at, at + own), "right") - 1
            lo = int(doc[0])
            left = off[doc + 1] - np.arange(at, at + own)  # bytes to the end of the text
            for k in ORDERS:
                m = min(own, len(seg) - k + 1)
                if m <= 0:
                    continue
                h = (sums[k: k + m] - sums[:m]) * INV[:m]
                h ^= h >> np.uint64(31)
                h = (h * np.uint64(0x9E3779B97F4A7C15 + 2 * k)) >> np.uint64(52)
                cell = (doc[:m] - lo) * DIMS + h.astype(np.int64)
                counts = np.bincount(cell[left[:m] >= k], minlength=(int(doc[-1]) - lo + 1) * DIMS)
                out[lo: int(doc[-1]) + 1] += counts.reshape(-1, DIMS)
    total = out.sum(axis=1, keepdims=True)
    return np.sqrt(out / np.maximum(total, 1))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of +1/-1 bits for each of ``n`` languages; no column is constant."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        # Exhaustive: every way to split the languages in two, once.
        rest = range(1, n)
        sets = [s for size in range(1, n) for s in combinations(rest, size)]
        return np.array([[-1.0 if i in s else 1.0 for s in sets] for i in range(n)])
    rng, bits, best, gap = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None, -1.0
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        least = min((code[i] != code[j]).sum() for i, j in combinations(range(n), 2))
        if least > gap:
            best, gap = code, least
    return best


def fit_codes(x: np.ndarray, y: np.ndarray, n_langs: int, rounds: int = 200, l2: float = 1e-4):
    """``(code, weights, bias, bit weights)``: logistic bits by gradient steps (Adam)."""
    code = codewords(n_langs)
    t = code[y]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for step in range(1, rounds + 1):
        f = x @ w + b
        g = (-t / (1 + np.exp(np.clip(t * f, -30, 30))) / len(y)).astype(np.float32)
        gw, gb = x.T @ g + l2 * w, g.sum(axis=0)
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
        w -= rate * m / (np.sqrt(v) + 1e-8)
        b -= rate * mb / (np.sqrt(vb) + 1e-8)
    right = (np.sign(x @ w + b) == t).astype(np.float64)
    acc = np.stack([right[y == c].mean(axis=0) if (y == c).any() else np.ones(code.shape[1]) for c in range(n_langs)])
    acc = np.maximum(acc, 1e-3)
    return code, w, b, acc / acc.sum(axis=1, keepdims=True)


def decode_codes(f: np.ndarray, code: np.ndarray, bit_weights: np.ndarray) -> np.ndarray:
    """Weighted loss of each language for each row of bit margins ``f``."""
    margin = f[:, None, :] * code[None]
    return (bit_weights[None] * np.logaddexp(0, -margin)).sum(axis=2) * code.shape[1]


def labelled_vectors(docs: DataFrame, max_labelled: int, key: str = "doc_id"):
    """At most ``max_labelled`` rows ``(lang, vector)``, collected: one of each key and language, those with the smallest hashes of both."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col(key).alias("key"), "lang", "text")
    some = one_of_each(known, ["key", "lang"], ["text"], max_labelled).select("lang", "text")

    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for lo, hi in doc_blocks(off):
                x = block_vectors(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]).astype("<f2")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"])

    rows = some.mapInArrow(run, "lang string, x binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["x"]))
    langs = sorted({r["lang"] for r in rows})
    x = np.array([np.frombuffer(r["x"], "<f2") for r in rows], np.float32).reshape(len(rows), DIMS)
    return langs, x, np.array([langs.index(r["lang"]) for r in rows], np.int64)


RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()),
                       T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])


def identify(docs: DataFrame, training: DataFrame, max_labelled: int = 3000, least_lead: float = 0.2) -> DataFrame:
    """``(doc_id, lang_pred, score, ambiguous)`` of every row of ``docs``, learned from ``training``."""
    ship(docs.sparkSession)
    langs, x, y = labelled_vectors(training, max_labelled)
    code, w, b, bit_weights = fit_codes(x, y, len(langs)) if len(langs) > 1 else (np.ones((1, 1)), np.zeros((DIMS, 1), np.float32),
                                                                               np.ones(1, np.float32), np.ones((1, 1)))

    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for lo, hi in doc_blocks(off):
                part, o = data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
                n = hi - lo
                letters = np.diff(np.concatenate(([0], np.cumsum(_ASCII_LETTER[part])))[o]) > 0
                for i in np.flatnonzero(~letters).tolist():
                    letters[i] = any(c.isalpha() for c in part[o[i]: o[i + 1]].tobytes().decode("utf-8", "ignore"))
                if not langs:
                    letters[:] = False
                pred, score, close = [None] * n, np.zeros(n), np.zeros(n, bool)
                if langs:
                    loss = decode_codes(block_vectors(part, o) @ w + b, code, bit_weights)
                    best = loss.argmin(axis=1)
                    p = np.exp(loss.min(axis=1, keepdims=True) - loss)
                    score = np.where(letters, 1 / p.sum(axis=1), 0.0)
                    if len(langs) > 1:
                        two = np.sort(loss, axis=1)[:, :2]
                        close = letters & (two[:, 1] - two[:, 0] < least_lead)
                    pred = [langs[k] for k in best.tolist()]
                pred = [p if ok else "und" for p, ok in zip(pred, letters.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(pred, pa.string()), pa.array(score), pa.array(close)],
                    names=RESULT.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RESULT)


def language_report(docs: DataFrame, max_labelled: int = 3000) -> DataFrame:
    """Per document its fold, language and score; folds other than 2 of 4 train."""
    training = docs.select("doc_id", "lang", "text").filter(fold(F.col("doc_id"), 4) != 2)
    return identify(docs.select("doc_id", "text"), training, max_labelled).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
