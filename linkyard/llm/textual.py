"""Arrow text columns as numpy byte arrays: word bounds and word hashes.

All work is per Arrow batch and in blocks of about half a megabyte, so memory does
not depend on the length of a text beyond the text itself.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18

# Byte classes of the word patterns.
#   SPACED: words are [^\x20\x09-\x0D]+      ALNUM: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lowered
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x41:0x5B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_codes(seed: int, lower: bool = True) -> np.ndarray:
    """One random 64-bit code per byte; A-Z share the codes of a-z if ``lower``."""
    with np.errstate(over="ignore"):
        codes = mix64((np.arange(1, 257, dtype=np.uint64) + np.uint64(seed * 1000)) * np.uint64(0x9E3779B97F4A7C15))
    return codes[LOWER] if lower else codes


_BASE = 0x9E3779B97F4A7C15 | 1
CODES, RAW_CODES = byte_codes(1), byte_codes(1, lower=False)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


POW = _powers(_BASE, BLOCK + 1)
INV = _powers(pow(_BASE, -1, 2**64), BLOCK + 1)


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a text column: text i is ``bytes[offsets[i]:offsets[i+1]]``; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = col.chunk(0) if col.num_chunks else pa.array([], pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def doc_blocks(offsets: np.ndarray, limit: int = 2 * BLOCK):
    """Ranges of documents ``lo, hi`` of about ``limit`` bytes, one document at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_bounds(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = SPACED):
    """``(starts, ends, doc)`` of every word; a word never crosses a document's end."""
    if not len(data):
        e = np.empty(0, np.int64)
        return e, e, e
    m = word_byte[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = m
    starts = np.flatnonzero(m & (~before[:-1] | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = m[1:]
    ends = np.flatnonzero(m & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, doc


def _long_hash(piece: np.ndarray, codes: np.ndarray) -> np.uint64:
    h, scale = np.uint64(0), np.uint64(1)
    with np.errstate(over="ignore"):
        for at in range(0, len(piece), BLOCK):
            part = piece[at: at + BLOCK]
            h += scale * np.sum(codes[part] * POW[: len(part)], dtype=np.uint64)
            scale *= POW[len(part)]
    return h


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``: a polynomial over random byte
    codes, from prefix sums, then mixed.  Equal bytes give equal hashes anywhere."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = int(np.searchsorted(ends, starts[i] + BLOCK, "right"))
            if j <= i:
                out[i] = _long_hash(data[starts[i]: ends[i]], codes)
                i += 1
                continue
            seg = data[starts[i]: ends[j - 1]]
            sums = np.zeros(len(seg) + 1, np.uint64)
            np.cumsum(codes[seg] * POW[: len(seg)], out=sums[1:])
            s, e = starts[i:j] - starts[i], ends[i:j] - starts[i]
            out[i:j] = (sums[e] - sums[s]) * INV[s]
            i = j
    return mix64(out)


def per_doc(offsets_doc: np.ndarray, n_docs: int) -> np.ndarray:
    """First word of each document and the end, from the words' document numbers."""
    return np.searchsorted(offsets_doc, np.arange(n_docs + 1), "left")


def find(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of each ``x`` in ``sorted_keys``, -1 if absent."""
    if not len(sorted_keys) or not len(x):
        return np.full(len(x), -1, np.int64)
    at = np.searchsorted(sorted_keys, x)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == x, at, -1)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Spark keeps more workers than run at once, and the
    allocators of an idle one hold on to what its largest block took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)
