"""Katz backoff scores from Good-Turing discounted counts.

Tokens are the lower-cased words of a text and one end.  The model has two levels, the second asked
only when the first has no count:

* word pairs, all of them: ``P(u | v) = d(c) c(v, u) / c(v)`` if the pair was seen, else ``alpha(v) P(u)``;
* single words: ``P(u) = d(c) c(u) / N``, the mass that discounting frees going to one unknown word.

``d`` are Katz's Good-Turing discounts (counts up to 5; where the counts of counts allow none,
an absolute discount).  ``alpha(v)`` is the mass freed after ``v`` over the single-word mass of the
words not seen after it, so ``P(. | v)`` sums to one for every ``v``; where no count after ``v`` is
discounted, the seen words are scaled by ``c(v) / (c(v) + 1)``.

A text's score is the sum over its words ``w`` of ``log P(w) + log alpha(w)``, and over its seen pairs of
``log P(u | v) - log alpha(v) - log P(u)``; so words and pairs are looked up apart, in one exchange.

Counts and pair tables are Parquet tables of sorted arrays by hash bucket.  Words that make up at least one in
``cached`` of all training tokens, and pairs of two such words of at least one in ``hot_pairs``, are copied to every
task; that changes where a count is found, not the score.  The pairs after any other word lie in that word's bucket, which
they cannot fill; the pairs after a cached word are spread by the hash of both.  Words are told apart by 64-bit
hashes, pairs by a 64-bit hash of both.

Defined results: null and empty texts are one end token; repeated rows are scored one by one; with no
training texts every score is 0; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scan_partitions
from .blobs import bucket_of, by_bucket, count_sorted, pack, pack_sorted, unpack, unpack_sorted
from .ship import partitions_for, ship, stored
from .textual import SPACED, doc_blocks, find, per_doc, text_bytes, word_bounds, word_hashes
from .toxicity import fold

FLUSH = 1 << 22  # tokens a map task holds before it sends them
DISCOUNTED = 5

COUNTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("keys", T.BinaryType()),
                       T.StructField("counts", T.BinaryType())])


def discounts(n: np.ndarray) -> np.ndarray:
    """``d[c]`` for counts 0..6 (6: any larger count) from the counts of counts ``n[c]``."""
    d = np.ones(DISCOUNTED + 2)
    d[0] = 0
    r = np.arange(1, DISCOUNTED + 1)
    if (n[1: DISCOUNTED + 2] > 0).all():
        common = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1]
        turing = (r + 1) * n[r + 1] / (n[r] * r)
        katz = (turing - common) / (1 - common) if common < 1 else np.zeros(DISCOUNTED)
        if ((katz > 0) & (katz < 1)).all():
            d[r] = katz
            return d
    off = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    d[1: DISCOUNTED + 2] = 1 - min(max(off, 0.05), 0.95) / np.arange(1, DISCOUNTED + 2)
    d[DISCOUNTED + 1] = 1.0
    if n[1: DISCOUNTED + 1].sum() == 0:
        d[DISCOUNTED + 1] = 0.999  # no small count to take mass from
    return d


def _sums(keys: np.ndarray, counts: np.ndarray, n_buckets: int):
    for k, at in by_bucket(keys, n_buckets):
        yield pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([pack_sorted(keys[at])], pa.binary()),
             pa.array([pack(counts[at].astype(np.uint64))], pa.binary())], names=COUNTS.names)


def _count_keys(make_keys, n_buckets: int):
    """Distinct keys of all blocks of texts with their counts, as rows by bucket."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, off = text_bytes(batch.column(0))
            for lo, hi in doc_blocks(off):
                keys = make_keys(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
                held.append(keys)
                size += len(keys)
                if size >= FLUSH:
                    yield from _sums(*count_sorted(np.concatenate(held)), n_buckets)
                    held, size = [], 0
        if size:
            yield from _sums(*count_sorted(np.concatenate(held)), n_buckets)

    return run


def _merge(batches):
    """Rows sorted by bucket to one row per bucket."""
    now, keys, counts = None, [], []

    def row():
        k, c = count_sorted(np.concatenate(keys), np.concatenate(counts))
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([pack_sorted(k)], pa.binary()),
                                           pa.array([pack(c)], pa.binary())], names=COUNTS.names)

    for batch in batches:
        for b, k, c in zip(*(x.to_pylist() for x in batch.columns)):
            if b != now:
                if keys:
                    yield row()
                now, keys, counts = b, [], []
            keys.append(unpack_sorted(k))
            counts.append(unpack(c, np.uint64))
    if keys:
        yield row()


def count_table(texts: DataFrame, make_keys, n_buckets: int, tag: str) -> DataFrame:
    """A stored table of the counts of all keys of ``texts(text)``: one row per bucket."""
    parts = texts.mapInArrow(_count_keys(make_keys, n_buckets), COUNTS)
    merged = parts.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_merge, COUNTS)
    return stored(merged, tag)


def _profile(table: DataFrame, least: int = 0):
    """``(N, V, counts of counts 1..6)`` of a table; with ``least``, its keys of at least that count."""

    def profile(batches):
        for batch in batches:
            for blob in batch.column(2).to_pylist():
                c = unpack(blob, np.uint64)
                n = np.bincount(np.minimum(c, DISCOUNTED + 2).astype(np.int64), minlength=DISCOUNTED + 3)
                yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (c.sum(), len(c), *n[1: DISCOUNTED + 2])],
                                                 names=["n", "v", *(f"n{r}" for r in range(1, DISCOUNTED + 2))])

    def frequent(batches):
        for batch in batches:
            for kb, cb in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                k, c = unpack_sorted(kb), unpack(cb, np.uint64)
                at = c >= least
                yield pa.RecordBatch.from_arrays([pa.array(k[at].view(np.int64)), pa.array(c[at].astype(np.int64))], names=["k", "c"])

    if least:
        rows = table.mapInArrow(frequent, "k long, c long").toArrow()
        k = rows.column(0).to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(k)
        return k[order], rows.column(1).to_numpy().astype(np.int64)[order]
    names = ["n", "v", *(f"n{r}" for r in range(1, DISCOUNTED + 2))]
    row = table.mapInArrow(profile, ", ".join(f"{x} long" for x in names)).agg(*[F.sum(x) for x in names]).head()
    values = [int(x or 0) for x in row]
    return values[0], values[1], np.array([0, *values[2:]], np.float64)


def _words(part, off):
    s, e, d = word_bounds(part, off, SPACED)
    return word_hashes(part, s, e), d


def _word_keys(part, off):
    return _words(part, off)[0]


def _freed(n_words: int, n1: np.ndarray, d1: np.ndarray) -> float:
    """Counts that discounting takes from all words, by count class: they belong to the unknown word."""
    small = np.arange(1, DISCOUNTED + 1)
    large = n_words - float((n1[small] * small).sum())
    return n_words - (float((n1[small] * small * d1[small]).sum()) + large * d1[DISCOUNTED + 1])


# --- all pairs -------------------------------------------------------------

PAIR_FLUSH = 1 << 21  # tokens whose pairs a map task holds before it counts and sends them
LOOKUP_FLUSH = 1 << 22  # tokens a map task holds before it sends them to be looked up
PAIR_BUCKET_BYTES = 8 << 20
BEGIN, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # as words, beside the words' hashes


def pair_hash(v: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A 64-bit key of two words' hashes, in this order."""
    with np.errstate(over="ignore"):
        h = v * np.uint64(0xD1B54A32D192ED03) + u
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xAEF17502108EF2D9)
        return h ^ (h >> np.uint64(29))


def _word_pairs(h: np.ndarray, d: np.ndarray, n: int):
    """``(v, u, doc)`` of all pairs of ``n`` texts of the words ``h``: begin, words, end."""
    first = per_doc(d, n)
    u = np.empty(len(h) + n, np.uint64)
    u[np.arange(len(h)) + d] = h
    u[first[1:] + np.arange(n)] = END
    v = np.empty_like(u)
    v[1:] = u[:-1]
    v[first[:-1] + np.arange(n)] = BEGIN
    return v, u, np.repeat(np.arange(n), np.diff(first) + 1)


def _cut(buckets: np.ndarray, n_buckets: int):
    """``(bucket, indices)`` of the rows of each bucket, in their order."""
    order = np.argsort(buckets, kind="stable")
    cut = np.searchsorted(buckets[order], np.arange(n_buckets + 1))
    for k in np.flatnonzero(np.diff(cut)):
        yield int(k), order[cut[k]: cut[k + 1]]


@dataclass
class Cache:
    """The frequent words, begin and end: sorted hashes with training counts.  A word's code is its place here,
    or else its hash."""

    keys: np.ndarray
    counts: np.ndarray

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        at = find(self.keys, hashes)
        return np.where(at >= 0, at.astype(np.uint64), hashes)

    def cached(self, codes: np.ndarray) -> np.ndarray:
        return codes < np.uint64(len(self.keys))

    def hashes(self, codes: np.ndarray) -> np.ndarray:
        known = self.cached(codes)
        return np.where(known, self.keys[np.where(known, codes, np.uint64(0)).astype(np.int64)], codes)

    def buckets(self, codes: np.ndarray, keys: np.ndarray, n_buckets: int) -> np.ndarray:
        """Bucket of pairs by one of their words if it is rare, else by their key."""
        return bucket_of(np.where(self.cached(codes), keys, codes), n_buckets)


#: Pairs ``v, u`` by codes with counts ``c``, and ``cu``, the count of ``u`` where it is rare (else 0).
PAIRS = T.StructType([T.StructField("bucket", T.IntegerType()), *(T.StructField(x, T.BinaryType()) for x in ("v", "counts", "u", "cu"))])
#: On the way there, with the words' table (kind 0).
FOUND = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("kind", T.IntegerType()),
                      *(T.StructField(x, T.BinaryType()) for x in ("u", "counts", "v"))])


def _count_pairs(cache: Cache, n_buckets: int):
    """Distinct pairs of texts with their counts, dealt by ``u``."""

    def sums(vs, us):
        v, u = np.concatenate(vs), np.concatenate(us)
        vs.clear()
        us.clear()
        key = pair_hash(v, u)
        _, first, c = np.unique(key, return_index=True, return_counts=True)
        key, v, u = key[first], cache.codes(v[first]), cache.codes(u[first])
        order = np.argsort(u, kind="stable")
        key, v, u, c = key[order], v[order], u[order], c[order]
        for b, at in _cut(cache.buckets(u, key, n_buckets), n_buckets):
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([1], pa.int32()), *(pa.array([x], pa.binary()) for x in (
                    pack_sorted(u[at]), pack(c[at].astype(np.uint64)), pack(v[at])))], names=FOUND.names)

    def run(batches):
        vs, us, size = [], [], 0
        for batch in batches:
            data, off = text_bytes(batch.column(0))
            for lo, hi in doc_blocks(off):
                h, d = _words(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
                v, u, _ = _word_pairs(h, d, hi - lo)
                vs.append(v)
                us.append(u)
                size += len(u)
                if size >= PAIR_FLUSH:
                    yield from sums(vs, us)
                    size = 0
        if size:
            yield from sums(vs, us)

    return run


def _merge_pairs(cache: Cache, n_buckets: int):
    """Words and pairs sorted by bucket of ``u`` and kind, to each pair once with the count of ``u``, dealt by ``v``."""

    def sums(have, counts, rows):
        v, u, c = (np.concatenate(x) for x in zip(*rows))
        rows.clear()
        key = pair_hash(cache.hashes(v), cache.hashes(u))
        order = np.argsort(key, kind="stable")
        key, v, u, c = key[order], v[order], u[order], c[order]
        first = np.flatnonzero(np.concatenate((np.ones(1, bool), key[1:] != key[:-1])))
        key, v, u, c = key[first], v[first], u[first], np.add.reduceat(c, first)
        order = np.argsort(v, kind="stable")
        key, v, u, c = key[order], v[order], u[order], c[order]
        cu, rare = np.zeros(len(u), np.uint64), np.flatnonzero(~cache.cached(u))
        cu[rare] = counts[find(have, u[rare])]
        for b, at in _cut(cache.buckets(v, key, n_buckets), n_buckets):
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), *(pa.array([x], pa.binary()) for x in (
                    pack_sorted(v[at]), pack(c[at]), pack(u[at]), pack(cu[at])))], names=PAIRS.names)

    def run(batches):
        now, rows, have, counts = None, [], np.empty(0, np.uint64), np.empty(0, np.uint64)
        for batch in batches:
            for b, kind, ub, cb, vb in zip(*(x.to_pylist() for x in batch.columns)):
                if b != now:
                    if rows:
                        yield from sums(have, counts, rows)
                    now, have, counts = b, np.empty(0, np.uint64), np.empty(0, np.uint64)
                if kind == 0:
                    have, counts = unpack_sorted(ub), unpack(cb, np.uint64)
                else:
                    rows.append((unpack(vb, np.uint64), unpack_sorted(ub), unpack(cb, np.uint64)))
        if rows:
            yield from sums(have, counts, rows)

    return run


def _unpack_pairs(vb, cb, ub, cub):
    return unpack_sorted(vb), unpack(cb, np.uint64).astype(np.int64), unpack(ub, np.uint64), unpack(cub, np.uint64).astype(np.int64)


def _gather_pairs(batches):
    """Rows sorted by bucket to one row per bucket."""
    now, rows = None, []

    def row():
        v, c, u, cu = (np.concatenate(x) for x in zip(*rows))
        at = np.argsort(v, kind="stable")
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int32()), *(pa.array([x], pa.binary()) for x in (
                pack_sorted(v[at]), pack(c[at].astype(np.uint64)), pack(u[at]), pack(cu[at].astype(np.uint64))))], names=PAIRS.names)

    for batch in batches:
        for b, *blobs in zip(*(x.to_pylist() for x in batch.columns)):
            if b != now:
                if rows:
                    yield row()
                now, rows = b, []
            rows.append(_unpack_pairs(*blobs))
    if rows:
        yield row()


def _first_of(v: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(v)), bool), v[1:] != v[:-1])))


@dataclass
class PairKatz:
    """What every task needs of the model of all pairs; its size is bounded by ``cached`` and ``hot_pairs``."""

    n_train: int
    n: int
    v: int
    cache: Cache
    p: np.ndarray         # P(u) of cached words and end
    d1: np.ndarray
    d2: np.ndarray
    unknown: float
    shrink: float         # what words are scaled by to make room for the unknown word
    seen: np.ndarray | None = None   # by cached v: scale(v) / c(v)
    alpha: np.ndarray | None = None  # by cached v
    hot: np.ndarray | None = None    # sorted keys of the frequent pairs
    hot_gain: np.ndarray | None = None

    def word(self, counts: np.ndarray) -> np.ndarray:
        """P of words by their training counts (0: the unknown word)."""
        p = self.shrink * self.d1[np.minimum(counts, DISCOUNTED + 1)] * counts / max(self.n, 1)
        return np.where(counts > 0, p, self.unknown)

    def after(self, u: np.ndarray, cu: np.ndarray) -> np.ndarray:
        """``P(u)`` of codes, with the counts of rare ones."""
        known = self.cache.cached(u)
        return np.where(known, self.p[np.where(known, u, np.uint64(0)).astype(np.int64)], self.word(cu))

    def cut(self, c: np.ndarray) -> np.ndarray:
        return self.d2[np.minimum(c, DISCOUNTED + 1)] * c

    def backoff(self, c: np.ndarray, kept: np.ndarray, mass: np.ndarray):
        """``scale(v) / c(v)`` and ``alpha(v)`` from the sums over the words seen after ``v``."""
        share = kept / np.maximum(c, 1)
        # Where no count after v is discounted, one more count makes room for the words not seen there.
        scale = np.where(share > 1 - 1e-9, c / (c + 1), 1.0)
        # The unknown word is never seen, so there is always room for it.
        return scale / np.maximum(c, 1), np.where(c > 0, (1 - scale * share) / np.maximum(1 - mass, self.unknown), 1.0)

    def sums(self, v: np.ndarray, c: np.ndarray, p: np.ndarray):
        """``(first, c(v), kept, mass)`` of ascending ``v``."""
        first = _first_of(v)
        add = lambda x: np.add.reduceat(x, first) if len(first) else x
        return first, add(c), add(self.cut(c)), add(p)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.n + self.v + 1))


def train_pairs(training: DataFrame, cached: int = 1 << 17, hot_pairs: int = 1 << 19):
    """``(PairKatz, word table, pair table, buckets)`` learned from all pairs of ``training(text)``."""
    spark = training.sparkSession
    ship(spark)
    texts = training.select(F.coalesce("text", F.lit("")).alias("text"))
    n_train, n_bytes = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()
    n_buckets = partitions_for(n_bytes, PAIR_BUCKET_BYTES)
    words = count_table(texts, _word_keys, n_buckets, "katz-words")
    n_words, v_words, n1 = _profile(words)
    n, v = n_words + n_train, v_words + (n_train > 0)
    vocab, counts = _profile(words, max(1, -(-n // cached)))
    keys, counts = np.concatenate((vocab, [BEGIN, END])), np.concatenate((counts, [n_train, n_train]))
    order = np.argsort(keys)
    cache = Cache(keys[order], counts[order])
    d1 = discounts(n1)
    unknown, shrink = (_freed(n_words, n1, d1) / n if n else 1.0), 1.0
    if unknown <= 0:  # a corpus of end tokens only
        unknown, shrink = 1.0 / (n + 1), n / (n + 1)
    parts = texts.mapInArrow(_count_pairs(cache, n_buckets), FOUND).union(
        words.select("bucket", F.lit(0).alias("kind"), F.col("keys").alias("u"), "counts", F.lit(b"").alias("v")))
    dealt = parts.repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_merge_pairs(cache, n_buckets), PAIRS)
    pairs = stored(dealt.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_gather_pairs, PAIRS), "katz-pairs")
    _, _, n2 = _profile(pairs)
    model = PairKatz(n_train, n, v, cache, np.ones(len(cache.keys)), d1, discounts(n2), unknown, shrink)
    model.p = model.word(cache.counts)
    model.p[find(cache.keys, np.array([END]))] = shrink * n_train / n if n else 1.0

    def contexts(batches):
        for batch in batches:
            for _, *blobs in zip(*(x.to_pylist() for x in batch.columns)):
                w, c, u, cu = _unpack_pairs(*blobs)
                most = int(np.searchsorted(w, np.uint64(len(cache.keys))))  # codes come before hashes
                first, *sums = model.sums(w[:most], c[:most], model.after(u[:most], cu[:most]))
                yield pa.RecordBatch.from_arrays([pa.array(w[first].astype(np.int64)), *map(pa.array, sums)], names=["v", "c", "kept", "mass"])

    context, kept, mass = (np.zeros(len(cache.keys)) for _ in range(3))
    # One row per cached word.
    rows = pairs.mapInArrow(contexts, "v long, c long, kept double, mass double").groupBy("v").agg(
        F.sum("c").alias("c"), F.sum("kept").alias("kept"), F.sum("mass").alias("mass")).toArrow()
    at = rows.column("v").to_numpy()
    for name, into in (("c", context), ("kept", kept), ("mass", mass)):
        into[at] = rows.column(name).to_numpy()
    model.seen, model.alpha = model.backoff(context, kept, mass)
    least = max(2, -(-n // hot_pairs))

    def hot(batches):
        for batch in batches:
            for _, *blobs in zip(*(x.to_pylist() for x in batch.columns)):
                w, c, u, cu = _unpack_pairs(*blobs)
                i = np.flatnonzero((c >= least) & cache.cached(w))
                gain = np.log10(model.seen[w[i].astype(np.int64)] * model.cut(c[i]) / model.alpha[w[i].astype(np.int64)] / model.after(u[i], cu[i]))
                key = pair_hash(cache.hashes(w[i]), cache.hashes(u[i]))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(gain)], names=["k", "gain"])

    rows = pairs.mapInArrow(hot, "k long, gain double").toArrow()
    k = rows.column(0).to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(k)
    model.hot, model.hot_gain = k[order], rows.column(1).to_numpy()[order]
    return model, words, pairs, n_buckets


# --- scoring ---------------------------------------------------------------

#: One exchange carries tables (kind 0: words, 1: pairs), the tokens to look up there (2: words, 3: pairs) and the
#: texts' own sums (4); ``part`` and the positions in ``docs`` name the texts.
WIDE = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("part", T.IntegerType()),
                     *(T.StructField(x, T.BinaryType()) for x in ("keys", "docs", "u", "cu"))])
SUMS = np.dtype([("doc", "<u4"), ("known", "<u4"), ("base", "<f8"), ("score", "<f8")])
#: Per map task: the positions of its texts with partial sums, and (kind 4) their keys and sizes.
PARTIAL = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("kind", T.IntegerType()),
                        T.StructField("sums", T.BinaryType()), T.StructField("heads", T.BinaryType())])
HEAD = np.dtype([("doc", "<u4"), ("null", "<u4"), ("key", "<i8"), ("tokens", "<i8")])


def _packed(sums: np.ndarray) -> bytes:
    """Sums of distinct texts, ascending, column by column."""
    parts = [pack_sorted(sums["doc"].astype(np.uint64)), pack(sums["known"].astype("<u4")), pack(np.concatenate((sums["base"], sums["score"])).view("<u8"))]
    return b"".join(len(x).to_bytes(4, "little") + x for x in parts)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(texts, known, base, score)`` of ``_packed``."""
    parts, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at: at + 4], "little")
        parts.append(blob[at + 4: at + 4 + n])
        at += 4 + n
    values = unpack(parts[2], "<u8").view(np.float64)
    return unpack_sorted(parts[0]).astype(np.int64), unpack(parts[1], "<u4"), values[: len(values) // 2], values[len(values) // 2:]


def _partial(part, sums, head=b"", kind=0):
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([kind], pa.int32()),
                                       pa.array([sums], pa.binary()), pa.array([head], pa.binary())], names=PARTIAL.names)


def _pair_parcels(model: PairKatz, n_buckets: int):
    cache = model.cache
    begin, end = (int(find(cache.keys, np.array([x]))[0]) for x in (BEGIN, END))
    edges = float(np.log10(model.p[end] * model.alpha[begin]))
    word_gain = np.log10(model.p * model.alpha)  # log P(w) + log alpha(w)

    def parcel(bucket, kind, part, keys, docs):
        return pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) for x in (bucket, kind, part)]
                                          + [pa.array([x], pa.binary()) for x in (keys, docs, b"", b"")], names=WIDE.names)

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {2: [], 3: []}
        size = 0

        def send():
            for kind, chunks in held.items():
                if not chunks:
                    continue
                keys, docs, buckets = (np.concatenate(x) for x in zip(*chunks))
                order = np.argsort(keys, kind="stable")
                keys, docs, buckets = keys[order], docs[order].astype("<u4"), buckets[order]
                for b, i in _cut(buckets, n_buckets):
                    yield parcel(b, kind, part, pack_sorted(keys[i]), pack(docs[i]))
                chunks.clear()

        for batch in batches:
            ids = batch.column(0)
            empty = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, off = text_bytes(batch.column(1))
            for lo, hi in doc_blocks(off):
                h, d = _words(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
                n = hi - lo
                where = find(cache.keys, h)
                rare = np.flatnonzero(where < 0)
                held[2].append((h[rare], at + d[rare], bucket_of(h[rare], n_buckets)))
                common = np.flatnonzero(where >= 0)
                v, u, of = _word_pairs(h, d, n)
                keys = pair_hash(v, u)
                hot = find(model.hot, keys)
                is_hot = hot >= 0
                sums = np.zeros(n, SUMS)
                sums["doc"] = at + np.arange(n)
                sums["known"] = np.bincount(d[common], minlength=n) + (model.n_train > 0)
                sums["base"] = np.bincount(d[common], model.base(cache.counts[where[common]]), n) + model.base(np.array(model.n_train))
                sums["score"] = (np.bincount(d[common], word_gain[where[common]], n) + edges
                                 + np.bincount(of[is_hot], model.hot_gain[hot[is_hot]], n))
                cold = ~is_hot
                held[3].append((keys[cold], at + of[cold], cache.buckets(cache.codes(v[cold]), keys[cold], n_buckets)))
                size += len(keys)
                head = np.zeros(n, HEAD)
                head["doc"], head["null"], head["key"] = sums["doc"], empty[lo:hi], ids[lo:hi]
                head["tokens"] = np.bincount(of, minlength=n)
                yield parcel(part % n_buckets, 4, part, sums.tobytes(), head.tobytes())
                at += n
                if size >= LOOKUP_FLUSH:
                    yield from send()
                    size = 0
        yield from send()

    return run


def _pair_lookup(model: PairKatz):
    """Parcels sorted by bucket and kind to partial sums per map task of texts."""
    cache = model.cache
    none = np.empty(0, np.uint64), np.empty(0)

    def gains(vb, cb, ub, cub):
        """``(keys, gain)`` of a bucket's pairs, and ``(words, log alpha)`` of its rare words."""
        v, c, u, cu = _unpack_pairs(vb, cb, ub, cub)
        p = model.after(u, cu)
        most = int(np.searchsorted(v, np.uint64(len(cache.keys))))  # codes come before hashes
        first, *sums = model.sums(v[most:], c[most:], p[most:])
        seen, alpha = model.backoff(*sums)
        many = np.diff(np.append(first, len(v) - most))
        i = v[:most].astype(np.int64)
        ratio = np.concatenate((model.seen[i] / model.alpha[i], np.repeat(seen / alpha, many)))
        key, gain = pair_hash(cache.hashes(v), cache.hashes(u)), np.log10(ratio * model.cut(c) / p)
        order = np.argsort(key)
        return (key[order], gain[order]), (v[most:][first], np.log10(alpha))

    def take(table, keys):
        i = find(table[0], keys)
        out = np.zeros(len(keys), table[1].dtype)
        out[i >= 0] = table[1][i[i >= 0]]
        return out

    def together(sums):
        """One row per map task of texts: the sums of all its parcels in a bucket."""
        for part, cells in sums.items():
            docs, at = np.unique(np.concatenate([c[0] for c in cells]), return_inverse=True)
            out = np.zeros(len(docs), SUMS)
            out["doc"] = docs
            for k, name in ((1, "known"), (2, "base"), (3, "score")):
                out[name] = np.bincount(at, np.concatenate([c[k] for c in cells]), len(docs))
            yield _partial(part, _packed(out))

    def run(batches):
        now, sums = None, {}
        for batch in batches:
            for bucket, kind, part, kb, db, ub, cub in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != now:
                    yield from together(sums)
                    now, sums, words, pairs, alphas = bucket, {}, (none[0], np.empty(0, np.int64)), none, none
                if kind == 0:
                    words = unpack_sorted(kb), unpack(db, np.uint64).astype(np.int64)
                elif kind == 1:
                    pairs, alphas = gains(kb, db, ub, cub)
                elif kind == 4:
                    yield _partial(part, kb, db, 4)
                else:
                    keys = unpack_sorted(kb)
                    distinct, at = np.unique(unpack(db, "<u4"), return_inverse=True)
                    nothing = np.zeros(len(distinct))
                    if kind == 2:
                        c = take(words, keys)
                        cell = np.bincount(at, c > 0), np.bincount(at, model.base(c)), np.bincount(at, np.log10(model.word(c)) + take(alphas, keys))
                    else:
                        cell = nothing, nothing, np.bincount(at, take(pairs, keys))
                    sums.setdefault(part, []).append((distinct, *cell))
        yield from together(sums)

    return run


RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                       T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])


def _finish(batches):
    """Partial sums sorted by map task and kind (heads first) to one row per text."""
    now, heads, known, base, score = None, [], None, None, None

    def rows():
        h = np.sort(np.concatenate(heads), order="doc")
        return pa.RecordBatch.from_arrays(
            [pa.array(h["key"].copy(), pa.int64(), mask=h["null"] > 0), pa.array(h["tokens"].copy()),
             *(pa.array(x[h["doc"]]) for x in (known, base, score))], names=RESULT.names)

    waiting = []

    def add(blobs):
        nonlocal known, base, score
        n = 1 + max(int(h["doc"].max()) for h in heads)
        if known is None:
            known, base, score = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for docs, k, b, s in blobs:  # a text is there once in each
            known[docs] += k
            base[docs] += b
            score[docs] += s

    for batch in batches:
        for part, kind, sums, head in zip(*(c.to_pylist() for c in batch.columns)):
            if part != now:
                if heads:
                    add(waiting)
                    yield rows()
                now, heads, waiting, known = part, [], [], None
            if kind == 4:
                heads.append(np.frombuffer(head, HEAD))
                own = np.frombuffer(sums, SUMS)
                waiting.append((own["doc"].astype(np.int64), own["known"], own["base"], own["score"]))
            else:
                if waiting:
                    add(waiting)
                    waiting = []
                add([_unpacked(sums)])
    if heads:
        add(waiting)
        yield rows()


def katz_scores(docs: DataFrame, training: DataFrame, hot_pairs: int = 1 << 19, cached: int = 1 << 17) -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score, train_tokens)`` of every row of ``docs``.

    On the way a text is named by its map task and its place there.  A scan of files gives a task the same rows whenever it runs;
    rows that come out of a shuffle need not, so they are stored first."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if scan_partitions(rows) is None:
        rows = stored(rows, "katz-texts")
    model, words, pairs, n_buckets = train_pairs(training, cached, hot_pairs)
    pairs = pairs.select("bucket", F.lit(1).alias("kind"), F.lit(-1).alias("part"), F.col("v").alias("keys"), F.col("counts").alias("docs"), "u", "cu")
    words = words.select("bucket", F.lit(0).alias("kind"), F.lit(-1).alias("part"), "keys", F.col("counts").alias("docs"),
                         *(F.lit(b"").alias(x) for x in ("u", "cu")))
    parcels = rows.mapInArrow(_pair_parcels(model, n_buckets), WIDE).union(words).union(pairs)
    partial = parcels.repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_pair_lookup(model), PARTIAL)
    done = partial.repartition("part").sortWithinPartitions(F.col("part"), F.col("kind").desc()).mapInArrow(_finish, RESULT)
    empty = model.n_train == 0
    return done.withColumn("score", F.lit(0.0) if empty else F.col("score")).withColumn("train_tokens", F.lit(model.n).cast("long"))


def katz_report(docs: DataFrame) -> DataFrame:
    """Every document, scored by a model of the folds other than 2 of 7."""
    def held_out(key: Column) -> Column:
        return fold(key, 7) == 2

    scores = katz_scores(docs, docs.filter(~held_out(F.col("doc_id"))))
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
