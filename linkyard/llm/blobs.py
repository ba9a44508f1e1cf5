"""Number columns packed into binary cells, so that an exchange moves a few large rows.

A map task sorts its numbers, cuts them by bucket and sends one row per bucket; the task that
owns the bucket gets arrays back.  Values are packed by byte planes and zstd.
"""

from __future__ import annotations

import numpy as np
import zstandard


def pack(x: np.ndarray) -> bytes:
    """An integer array, compressed by byte planes."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    """The array of ``pack``."""
    dtype = np.dtype(dtype)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(dtype.itemsize, -1).T).view(dtype).reshape(-1)


def pack_sorted(x: np.ndarray) -> bytes:
    """An ascending unsigned 64-bit array, as its steps."""
    return pack(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket of each 64-bit key (a well-mixed hash) by its leading bits: a bucket is a range of keys, so the
    steps between its sorted keys are short."""
    return ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int32)


def by_bucket(keys: np.ndarray, n_buckets: int):
    """``(bucket, indices)`` of ascending ``keys``; within a bucket they stay ascending."""
    b = bucket_of(keys, n_buckets)
    order = np.argsort(b, kind="stable")
    cut = np.searchsorted(b[order], np.arange(n_buckets + 1))
    for k in range(n_buckets):
        if cut[k + 1] > cut[k]:
            yield k, order[cut[k]: cut[k + 1]]


def count_sorted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sum of their counts (or their number)."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts
