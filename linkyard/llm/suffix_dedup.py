"""Removal of long repeated byte strings with a sampled suffix array.

Every string of ``length`` bytes has an anchor: the place, among its first ``spread`` places, whose
16 bytes hash least.  Equal strings have their anchor at the same distance, so it is enough to sort
the suffixes that begin at anchors.  A suffix is a row of tokens: its leading eight bytes, a hash
of the bytes that all strings of its anchor share, and a hash of everything they
cover.  Sampled splitters cut the range of these rows, ties by text and place included, so that
not even a hot suffix fills a bucket; each bucket is sorted by multikey quicksort (the next token only
among ties), neighbours are compared, and the first and last rows of the buckets are
compared with each other.

A suffix that agrees with a neighbour in all tokens stands for strings that repeat altogether.  Where
neighbours agree in the shared part only, the strings themselves are sorted and compared the same
way, as two half-string hashes each.  Equal texts are one text from the start.

Texts and strings are told apart by 64-bit and 128-bit hashes.

Defined results: null is an empty text; texts shorter than ``length`` lose nothing; repeated rows lose
all of a text that is long enough; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blobs import pack, unpack
from .ship import partitions_for, ship, stored
from .textual import BLOCK, INV, POW, RAW_CODES, mix64, text_bytes

GRAM = 16
SPREAD = 160
FLUSH = 1 << 21  # suffixes a map task holds before it sends them
SAMPLED_TEXTS = 8000     # expected number of texts whose suffixes may become splitters
ROWS_PER_RANGE = 40      # expected number of sampled suffixes a range
ROW_BYTES = 40
_PLACE = np.uint64(0xFFFFF)


# --- suffixes --------------------------------------------------------------

def _sums(part: np.ndarray) -> np.ndarray:
    out = np.zeros(len(part) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(RAW_CODES[part] * POW[: len(part)], out=out[1:])
    return out


def _hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64((sums[b] - sums[a]) * INV[a])


def anchors(part: np.ndarray, length: int, spread: int):
    """``(tokens, first string, number of strings)`` of each anchor of one text piece of at most ``BLOCK`` bytes."""
    n = len(part)
    if n < length:
        return None
    sums = _sums(part)
    with np.errstate(over="ignore"):
        m = n - GRAM + 1
        h = (sums[GRAM:] - sums[:m]) * INV[:m]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
    # Sliding minimum by blocks: of a window, the end of one block and the beginning of the next.
    padded = np.full(-(-m // spread) * spread + spread, ~np.uint64(0))
    padded[:m] = (h & ~_PLACE) | np.arange(m, dtype=np.uint64)
    grid = padded.reshape(-1, spread)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    strings = n - length + 1
    place = (np.minimum(behind[:strings], ahead[spread - 1: spread - 1 + strings]) & _PLACE).astype(np.int64)
    change = place[1:] != place[:-1]
    first = np.flatnonzero(np.concatenate(([True], change)))
    last = np.flatnonzero(np.concatenate((change, [True])))
    p = place[first]
    lead = np.zeros(len(p), np.uint64)
    for k in range(8):
        lead = (lead << np.uint64(8)) | part[p + k].astype(np.uint64)
    shared = _hash(sums, p, p + length - spread + 1)
    extent = ((last - first) * (spread + 1) + p - first).astype(np.uint64)
    return [lead, shared, _hash(sums, first, last + length) ^ mix64(extent)], first, last - first + 1


def _pieces(n: int, length: int):
    """Ranges of string starts and the bytes they need, of a text of ``n`` bytes."""
    step = BLOCK - length
    for a in range(0, max(1, n - length + 1), step):
        yield a, min(n, a + step + length - 1)


def _anchor_rows(length: int, spread: int):
    def rows(batch):
        addr = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        data, off = text_bytes(batch.column(1))
        for i in range(len(addr)):
            text = data[off[i]: off[i + 1]]
            if len(text) < length:
                continue
            for a, b in _pieces(len(text), length):
                if (found := anchors(text[a:b], length, spread)) is not None:
                    tokens, first, n = found
                    yield tokens, np.full(len(first), addr[i]), first + a, n

    return rows


def _string_rows(length: int):
    """Rows of single strings: the two halves' hashes, for the runs of strings that each text lists."""

    def rows(batch):
        grow = zstandard.ZstdDecompressor()
        half = length // 2
        for addr, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
            part = np.frombuffer(grow.decompress(text), np.uint8)
            runs = unpack(runs, "<u4").astype(np.int64).reshape(2, -1)
            starts = np.unique(np.concatenate([np.arange(s, s + n) for s, n in runs.T]))
            key = np.int64(addr).view(np.uint64)
            for a, b in _pieces(len(part), length):
                s = starts[(starts >= a) & (starts + length <= b)] - a
                if len(s):
                    sums = _sums(part[a:b])
                    tokens = [_hash(sums, s, s + half), _hash(sums, s + half, s + length)]
                    yield tokens, np.full(len(s), key), s + a, np.ones(len(s), np.int64)

    return rows


# --- sorted exchange -------------------------------------------------------

def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their columns: by the first one, then only ties by the next."""
    order = np.argsort(columns[0])
    fresh = np.ones(len(order), bool)  # rows that differ from the row before them so far
    fresh[1:] = columns[0][order[1:]] != columns[0][order[:-1]]
    for c in columns[1:]:
        at = np.flatnonzero(~(fresh & np.concatenate((fresh[1:], [True]))))
        if not len(at):
            break
        rows = order[at]
        order[at] = rows[np.lexsort((c[rows], np.cumsum(fresh)[at]))]
        fresh[1:] |= c[order[1:]] != c[order[:-1]]
    return order


def _shared(columns: list[np.ndarray], n_tokens: int) -> np.ndarray:
    """Number of leading tokens that each row of sorted columns shares with the row before it."""
    n = len(columns[0])
    out, same = np.zeros(n, np.uint8), np.ones(max(0, n - 1), bool)
    for c in columns[:n_tokens]:
        same = same & (c[1:] == c[:-1])
        out[1:] += same
    return out


PARCEL = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n_rows", T.IntegerType()), T.StructField("cells", T.BinaryType())])


def _pack_rows(columns: list[np.ndarray]) -> bytes:
    parts = [pack(c) for c in columns]
    return np.array([len(parts), *map(len, parts)], "<i8").tobytes() + b"".join(parts)


def _unpack_rows(blob: bytes, dtypes) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, "<i8", 1)[0])
    sizes = np.frombuffer(blob, "<i8", n, 8)
    edge = 8 + 8 * n + np.concatenate(([0], np.cumsum(sizes)))
    return [unpack(blob[a:b], d) for a, b, d in zip(edge[:-1], edge[1:], dtypes)]


def _dtypes(n_tokens: int):
    return ["<u8"] * n_tokens + ["<u8", "<u4", "<u4", "u1"]


def _gather(make_rows, n_tokens: int, splitters: list[tuple]):
    """Rows of all batches, sorted and cut at the splitters.  Rows of equal tokens, text and place
    (copies of one text) travel as one, marked as met twice."""

    def send(held):
        cols = [np.concatenate([h[0][k] for h in held]) for k in range(n_tokens)]
        cols += [np.concatenate([h[k] for h in held]) for k in (1, 2, 3)]
        cols = [c[order] for order in [multikey_order([*cols[: n_tokens + 1], cols[n_tokens + 1].astype(np.uint64)])] for c in cols]
        same = np.ones(max(0, len(cols[0]) - 1), bool)
        for c in cols[: n_tokens + 2]:
            same &= c[1:] == c[:-1]
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        twice = np.diff(np.concatenate((first, [len(cols[0])]))) > 1
        cols = [c[first] for c in cols] + [twice.astype("u1")]
        cols[n_tokens + 1], cols[n_tokens + 2] = cols[n_tokens + 1].astype("<u4"), cols[n_tokens + 2].astype("<u4")
        cut = [0]
        for s in splitters:
            lo, hi = cut[-1], len(first)
            while lo < hi:
                mid = (lo + hi) // 2
                if tuple(int(c[mid]) for c in cols[: n_tokens + 2]) < s:
                    lo = mid + 1
                else:
                    hi = mid
            cut.append(lo)
        cut.append(len(first))
        for b, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])):
            if hi > lo:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([hi - lo], pa.int32()), pa.array([_pack_rows([c[lo:hi] for c in cols])], pa.binary())],
                    names=PARCEL.names)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in make_rows(batch):
                held.append(row)
                size += len(row[1])
                if size >= FLUSH:
                    yield from send(held)
                    held, size = [], 0
        if held:
            yield from send(held)

    return run


#: kind 0: verdicts for the texts of one address bucket; kind 1: the first and last rows of a bucket, with tokens.
VERDICT = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("bucket", T.IntegerType()), T.StructField("cells", T.BinaryType())])
VERDICT_TYPES = ["<u8", "<u4", "<u4", "u1", "u1"]  # text, first string, strings, tokens shared with the row before and after


def _verdict_rows(cols, n_buckets: int):
    where = (cols[0] % np.uint64(n_buckets)).astype(np.int32)
    order = np.argsort(where, kind="stable")
    cut = np.searchsorted(where[order], np.arange(n_buckets + 1))
    for b in range(n_buckets):
        if cut[b + 1] > cut[b]:
            at = order[cut[b]: cut[b + 1]]
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([b], pa.int32()),
                                              pa.array([_pack_rows([c[at] for c in cols])], pa.binary())], names=VERDICT.names)


def _compare(n_tokens: int, least: int, n_buckets: int):
    """Parcels sorted by bucket: sorts each bucket, compares neighbours, reports rows that share ``least`` tokens."""

    def report(bucket, held):
        cols = [np.concatenate([h[k] for h in held]) for k in range(n_tokens + 4)]
        order = multikey_order([*cols[: n_tokens + 1], cols[n_tokens + 1].astype(np.uint64)])
        cols = [c[order] for c in cols]
        before = _shared(cols, n_tokens)
        after = np.concatenate((before[1:], np.zeros(1, np.uint8)))
        twice = cols[-1] > 0
        # A row met twice in one task also has an equal neighbour; that does not hide the one it really has.
        best = np.where(twice, n_tokens, np.maximum(before, after)).astype("u1")
        inner = (best >= least)
        inner[[0, -1]] = False
        link = ((before == least) | (after == least)).astype("u1")
        yield from _verdict_rows([c[inner] for c in (*cols[n_tokens: n_tokens + 3], best, link)], n_buckets)
        ends = [0, len(order) - 1] if len(order) > 1 else [0]
        edge = [c[ends] for c in cols[: n_tokens + 3]] + [c[ends] for c in (before, after, cols[-1])]
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([bucket], pa.int32()),
                                          pa.array([_pack_rows(edge)], pa.binary())], names=VERDICT.names)

    def run(batches):
        now, held = None, []
        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if b != now:
                    if held:
                        yield from report(now, held)
                    now, held = b, []
                held.append(_unpack_rows(blob, _dtypes(n_tokens)))
        if held:
            yield from report(now, held)

    return run


def _edge_verdicts(rows, n_tokens: int, least: int) -> list[np.ndarray]:
    """Verdicts of the buckets' first and last rows, each compared across the boundary too."""
    types = ["<u8"] * n_tokens + ["<u8", "<u4", "<u4", "u1", "u1", "u1"]
    flat = []
    for r in sorted(rows, key=lambda r: r["bucket"]):
        cols = _unpack_rows(r["cells"], types)
        for i in range(len(cols[0])):
            flat.append([int(c[i]) for c in cols] + [r["bucket"]])

    def shared(x, y):
        n = 0
        while n < n_tokens and x[n] == y[n]:
            n += 1
        return n

    out = []
    for i, row in enumerate(flat):
        before, after, twice, bucket = row[n_tokens + 3:]
        if i and flat[i - 1][-1] != bucket:
            before = shared(flat[i - 1], row)
        if i + 1 < len(flat) and flat[i + 1][-1] != bucket:
            after = shared(row, flat[i + 1])
        best = n_tokens if twice else max(before, after)
        if best >= least:
            out.append((row[n_tokens], row[n_tokens + 1], row[n_tokens + 2], best, int(least in (before, after))))
    return [np.array([o[k] for o in out], d) for k, d in enumerate(VERDICT_TYPES)]


def shared_suffixes(rows: DataFrame, make_rows, n_tokens: int, least: int, n_texts: int, n_rows: float, row_bytes: int,
                    n_buckets: int, tag: str, range_bytes: int) -> DataFrame:
    """Verdict parcels by address bucket, of all rows that ``make_rows`` makes and that share ``least`` tokens with another.

    Splitters come from texts sampled over all of ``rows``, and of their suffixes (about ``n_rows`` in all, of ``n_texts`` texts)
    from those whose hash is small enough, ``ROWS_PER_RANGE`` a range: their number doesn't depend on the texts' lengths.
    """
    spark = rows.sparkSession
    n_ranges = partitions_for(n_rows * row_bytes, range_bytes)
    of_texts = min(1.0, SAMPLED_TEXTS / max(1, n_texts))
    of_rows = np.uint64(min(1.0, n_ranges * ROWS_PER_RANGE / max(1.0, n_rows * of_texts)) * (2**64 - 2**12))

    def keys(batches):
        for batch in batches:
            for tokens, addr, first, _ in make_rows(batch):
                with np.errstate(over="ignore"):
                    low = mix64(addr.astype(np.uint64) ^ (first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) <= of_rows
                tokens, addr, first = [t[low] for t in tokens], addr[low], first[low]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.uint64).view(np.int64)) for c in (*tokens, addr, first)],
                                                 names=[f"k{i}" for i in range(n_tokens + 2)])

    splitters: list[tuple] = []
    if n_ranges > 1:
        got = rows.sample(of_texts, seed=1).mapInArrow(keys, ", ".join(f"k{i} long" for i in range(n_tokens + 2))).toArrow()
        cols = [c.to_numpy().view(np.uint64) for c in got.columns]
        if len(cols[0]):
            order = multikey_order(cols)
            pick = order[np.unique((np.arange(1, n_ranges) * len(order)) // n_ranges)]
            splitters = sorted({tuple(int(c[i]) for c in cols) for i in pick})
    parcels = rows.mapInArrow(_gather(make_rows, n_tokens, splitters), PARCEL)
    found = stored(parcels.repartition(len(splitters) + 1, "bucket").sortWithinPartitions("bucket")
                   .mapInArrow(_compare(n_tokens, least, n_buckets), VERDICT), tag)
    edges = _edge_verdicts(found.filter("kind = 1").collect(), n_tokens, least)  # two rows per bucket
    late = [(int(b.column(1)[0].as_py()), b.column(2)[0].as_py()) for b in _verdict_rows(edges, n_buckets)] if len(edges[0]) else []
    more = spark.createDataFrame(late, "bucket int, cells binary")
    return found.filter("kind = 0").select("bucket", "cells").union(more)


# --- texts -----------------------------------------------------------------

BY_TEXT = T.StructType([T.StructField("addr", T.LongType()), T.StructField("whole", T.BinaryType()), T.StructField("runs", T.BinaryType())])


def _by_text(n_tokens: int):
    """Verdicts sorted by address bucket to one row per text: runs of repeated strings, and runs to look at one by one."""

    def report(held):
        addr, first, n, best, link = (np.concatenate([h[k] for h in held]) for k in range(5))
        order = np.lexsort((first, addr))
        addr, first, n, best, link = (c[order] for c in (addr, first, n, best, link))
        cut = np.flatnonzero(np.concatenate(([True], addr[1:] != addr[:-1], [True])))
        full = best == n_tokens
        look = link > 0
        out = ([], [], [])
        for a, b in zip(cut[:-1], cut[1:]):
            out[0].append(int(addr[a].view(np.int64)))
            for k, mask in ((1, full[a:b]), (2, look[a:b])):
                out[k].append(pack(np.concatenate((first[a:b][mask], n[a:b][mask])).astype("<u4")) if mask.any() else None)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())],
                                          names=BY_TEXT.names)

    def run(batches):
        now, held = None, []
        for batch in batches:
            for b, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if b != now:
                    if held:
                        yield report(held)
                    now, held = b, []
                held.append(_unpack_rows(blob, VERDICT_TYPES))
        if held:
            yield report(held)

    return run


def _merge_spans(runs: list[np.ndarray], length: int) -> np.ndarray:
    """Maximal byte ranges covered by strings, from arrays ``(first, number of strings)``."""
    spans = np.concatenate([r.reshape(2, -1).T for r in runs if len(r)] or [np.empty((0, 2), np.int64)]).astype(np.int64)
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    start, end = spans[:, 0], np.maximum.accumulate(spans[:, 0] + spans[:, 1] - 1 + length)
    fresh = np.concatenate(([True], start[1:] > end[:-1]))
    last = np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(start) - 1]))
    return np.stack((start[fresh], end[last]), axis=1)


CUT = T.StructType([
    T.StructField("addr", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
    T.StructField("span_from", T.ArrayType(T.LongType())), T.StructField("span_to", T.ArrayType(T.LongType())),
    T.StructField("kept", T.BinaryType()),
])


def _cut(length: int, with_bytes: bool):
    def run(batches):
        grow = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for addr, text, whole, single in zip(*(c.to_pylist() for c in batch.columns)):
                raw = grow.decompress(text)
                spans = _merge_spans([unpack(x, "<u4") for x in (whole, single) if x], length).tolist()
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                left = b"".join(kept)
                rows.append((addr, len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest(),
                             [a for a, _ in spans], [b for _, b in spans], left if with_bytes else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, (
                    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()))],
                names=CUT.names)

    return run


def remove_repeats(docs: DataFrame, length: int = 400, spread: int = SPREAD, key: str = "doc_id", with_bytes: bool = True,
                   range_bytes: int = 16 << 20) -> DataFrame:
    """Per row of ``docs``: bytes, removed bytes, maximal removed spans, and the bytes that stay.  Suffixes are
    dealt to ranges of about ``range_bytes``."""
    if length - spread + 1 < GRAM:
        raise ValueError("length must be at least spread + 15")
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(key).alias("_sd_key"), F.coalesce("text", F.lit("")).alias("text")).withColumn("addr", F.xxhash64("text"))
    slim = rows.select("addr", "text")
    n_docs, n_bytes = slim.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()
    n_buckets = partitions_for(n_bytes, 16 << 20)
    suffixes = shared_suffixes(slim, _anchor_rows(length, spread), 3, 2, n_docs, 2 * n_bytes / spread, ROW_BYTES, n_buckets, "suffixes", range_bytes)
    by_text = stored(suffixes.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_by_text(3), BY_TEXT), "suffix-texts")

    squeeze = F.arrow_udf(_squeeze, T.BinaryType())
    texts = slim.withColumn("z", squeeze("text")).groupBy("addr").agg(F.any_value("z").alias("z"))
    look = texts.join(by_text.filter(F.col("runs").isNotNull()).select("addr", "runs"), "addr").select("addr", "z", "runs")
    look = stored(look, "suffix-look")
    n_look = look.count()
    n_strings = look.mapInArrow(_count_strings, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    strings = shared_suffixes(look, _string_rows(length), 2, 2, n_look, n_strings, 28, n_buckets, "strings", range_bytes)
    single = stored(strings.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_by_text(2), BY_TEXT), "string-texts")

    found = texts.join(by_text.select("addr", F.col("whole").alias("a")), "addr", "left") \
        .join(single.select("addr", F.col("whole").alias("b")), "addr", "left").select("addr", "z", "a", "b")
    result = found.mapInArrow(_cut(length, with_bytes), CUT)
    return rows.select("_sd_key", "addr").join(result, "addr").drop("addr").withColumnRenamed("_sd_key", key)


def _squeeze(texts: pa.Array) -> pa.Array:
    press = zstandard.ZstdCompressor(level=1)
    data, off = text_bytes(texts)
    raw = data.tobytes()
    return pa.array([press.compress(raw[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())], pa.binary())


def _count_strings(batches):
    for batch in batches:
        n = 0
        for runs in batch.column(2).to_pylist():
            runs = unpack(runs, "<u4").reshape(2, -1)
            n += int(runs[1].astype(np.int64).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])


def repeat_report(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per document the counts and the digest of what stays."""
    return remove_repeats(docs.select("doc_id", "text"), length, with_bytes=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
