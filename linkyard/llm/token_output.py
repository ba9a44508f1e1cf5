"""Token ids in binary shards with a minimal perfect hash index.

A shard is one row of a Parquet table: the raw little-endian ids of consecutive
documents (ascending key), the bounds of each document, and an index over the
shard's distinct keys.  The index is a minimal perfect hash (levels of bit arrays;
a key takes the first level where it collides with no other) whose slots keep
a fingerprint and the key's first row and row count, so a key is found in constant
time without storing the keys.  A small directory has each shard's key range and
the number of ids before it.

Defined results: null text has only the end id; a null key sorts first; rows of
equal key stay together, ordered by their ids; an empty table gives no shard.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..session import scratch_path
from .ship import partitions_for, ship, stored
from .textual import byte_codes, doc_blocks, find, give_back, mix64, text_bytes, word_hashes

NULL_KEY = -(2**63)
GAMMA = 2.0
RANGES_PER_TASK = 8
KEYS_PER_RANGE = 20  # sampled keys per key range, on average
BLOCK_BYTES = 1 << 19


# --- minimal perfect hash --------------------------------------------------

def _level_hash(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = mix64(keys.view(np.uint64) + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15))
    return ((h >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return mix64(keys.view(np.uint64) ^ np.uint64(0xD6E8FEB86659FD93))


def build_mph(keys: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``(index bytes, slot of each key)`` of distinct int64 keys; slots are 0..n-1."""
    left, levels, slots = np.arange(len(keys)), [], np.empty(len(keys), np.int64)
    taken = 0
    while len(left):
        size = max(64, int(GAMMA * len(left)))
        at = _level_hash(keys[left], len(levels), size).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, bool)
        bits[at[alone]] = True
        rank = np.cumsum(bits) - 1
        slots[left[alone]] = taken + rank[at[alone]]
        taken += int(alone.sum())
        levels.append(bits)
        left = left[~alone]
    head = struct.pack("<q", len(levels)) + b"".join(struct.pack("<q", len(b)) for b in levels)
    return head + b"".join(np.packbits(b).tobytes() for b in levels), slots


class Mph:
    """Looks up slots in the bytes of ``build_mph``."""

    def __init__(self, index: bytes):
        (n,) = struct.unpack_from("<q", index)
        sizes = struct.unpack_from(f"<{n}q", index, 8)
        at, self.levels, taken = 8 + 8 * n, [], 0
        for size in sizes:
            width = -(-size // 8)
            bits = np.unpackbits(np.frombuffer(index, np.uint8, width, at), count=size).astype(bool)
            self.levels.append((bits, np.cumsum(bits) - 1 + taken))
            taken += int(bits.sum())
            at += width

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 if no level takes it.  Keys that were not indexed may
        also get a slot: compare the fingerprint."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, rank) in enumerate(self.levels):
            if not len(left):
                break
            at = _level_hash(keys[left], level, len(bits)).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


# --- encoding --------------------------------------------------------------

_ENCODERS: dict[str, "PieceEncoder"] = {}
_CODES = byte_codes(1, lower=False), byte_codes(2, lower=False)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others take the letters from code point 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}


def can_be_cut(tokenizer: dict) -> bool:
    """Whether a tokenizer (its JSON) is a byte-level BPE with the usual split pattern and nothing that looks across
    blanks, line feeds, stops or commas, so that texts may be encoded in pieces."""
    model, split = tokenizer.get("model") or {}, tokenizer.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    marks = [t for t in tokenizer.get("added_tokens") or []
             if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or not t.get("content") or set(t["content"]) & set(" \n.,")]
    return (model.get("type") == "BPE" and plain and not marks and tokenizer.get("normalizer") is None and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split.get("add_prefix_space"))


_VISIBLE = np.ones(256, bool)
_VISIBLE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = False
_ASCII_ALNUM = np.zeros(256, bool)
_ASCII_ALNUM[0x30:0x3A] = _ASCII_ALNUM[0x41:0x5B] = _ASCII_ALNUM[0x61:0x7B] = True
_SPACE_LEADS = np.zeros(256, bool)
_SPACE_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _visible(data: np.ndarray) -> np.ndarray:
    """Bytes that belong to no white space of Unicode (the control characters 28 to 31 count as white, too)."""
    seen = _VISIBLE[data]
    for i in np.flatnonzero(_SPACE_LEADS[data]).tolist() if _SPACE_LEADS[data].any() else []:
        two, three = data[i: i + 2].tobytes(), data[i: i + 3].tobytes()
        if two in (b"\xc2\x85", b"\xc2\xa0"):
            seen[i: i + 2] = False
        elif len(three) == 3 and three[0] != 0xC2 and three.decode("utf-8", "replace").isspace():
            seen[i: i + 3] = False
    return seen


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts begin, ascending; a text that is not empty begins one."""
    n = len(data)
    start = np.zeros(n + 1, bool)
    start[offsets] = True
    inside = ~start[:n]                      # not the first byte of a text
    goes_on = ~start[1:]                     # not the last one
    seen = _visible(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = seen[:-1], seen[1:]
    alone = before & after & inside & goes_on
    start[:n] |= alone & (data == 0x20)
    feed = np.flatnonzero(alone & (data == 0x0A))
    start[feed] = start[feed + 1] = True
    mark = np.flatnonzero(((data == 0x2E) | (data == 0x2C)) & inside)
    last = data[mark - 1]
    # Letters from U+00C0 to U+00FF are 0xC3 and a byte, but for the signs 0x97 and 0xB7.
    latin = (last >= 0x80) & (last != 0x97) & (last != 0xB7) & (mark >= 2) & (data[np.maximum(mark - 2, 0)] == 0xC3)
    start[mark[_ASCII_ALNUM[last] | latin]] = True
    return np.flatnonzero(start[:n])


class PieceEncoder:
    """Ids of whole texts by the tokenizers library, a piece at a time.

    A byte-level BPE with the usual split pattern always starts a new token at
    a single blank between two visible characters, on both sides of a single
    line feed between two, and before a stop or comma that follows a letter or
    digit.  So the ids of a text are the ids of the pieces between such places,
    one after another.  Pieces repeat; those met lately are remembered as two 64-bit hashes and their
    ids, up to twice ``keep`` of them, in plain arrays (about 33 bytes a piece).  A piece of letters is one word of the split pattern
    and goes straight to the library's model; any other goes through all of it.  With any other
    kind of tokenizer (``can_be_cut``) whole texts go through the library.
    """

    def __init__(self, tokenizer_path: str, keep: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_path)
        self.cuts = can_be_cut(json.loads(self.tok.to_str()))
        self.word = self.tok.model.tokenize
        self.letters = _byte_letters()
        self.width = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.keep = keep
        self.forget()

    @classmethod
    def shared(cls, tokenizer_path: str) -> "PieceEncoder":
        """One per worker process, so that later tasks find the pieces of earlier ones."""
        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = cls(tokenizer_path)
        return _ENCODERS[tokenizer_path]

    def _no_pieces(self):
        e = np.empty(0, np.uint64)
        return e, e, np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, self.width)

    def forget(self) -> None:
        """Hashes (ascending first ones), second hashes, where their ids begin, how many they are, ids in the order they
        were met: of late pieces and of those before them."""
        self.late = self.older = self._no_pieces()

    def _ids_of(self, pieces: list[str]) -> list[list[int]]:
        out: list = [None] * len(pieces)
        rest = []
        for i, p in enumerate(pieces):
            if p[:1] == " " and p[1:].isalpha():
                out[i] = [t.id for t in self.word(p.encode().decode("latin-1").translate(self.letters))]
            else:
                rest.append(i)
        for at in range(0, len(rest), 10_000):
            some = rest[at: at + 10_000]
            for i, e in zip(some, self.tok.encode_batch_fast([pieces[i] for i in some], add_special_tokens=False)):
                out[i] = e.ids
        return out

    @staticmethod
    def _gather(table, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(number of ids, ids)`` of the pieces at ``at``, one after the other."""
        _, _, begin, size, ids = table
        n = size[at].astype(np.int64)
        return n, ids[np.repeat(begin[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def _learn(self, one: np.ndarray, two: np.ndarray, pieces) -> None:
        """Make ``late`` hold all of the given distinct pieces; ``pieces(i)`` are the texts of those at ``i``."""
        if len(self.late[0]) > self.keep:
            self.older, self.late = self.late, self._no_pieces()
        new = np.flatnonzero(find(self.late[0], one) < 0)
        at = find(self.older[0], one[new])
        met = at >= 0
        met[met] = self.older[1][at[met]] == two[new[met]]  # else another piece with the same first hash
        n_old, old = self._gather(self.older, at[met])
        fresh = self._ids_of(pieces(new[~met]))
        ids = np.concatenate((self.late[4], old, np.array([i for x in fresh for i in x], self.width)))
        rows = np.concatenate((new[met], new[~met]))
        n = np.concatenate((n_old, np.array([len(x) for x in fresh], np.int64)))
        begin = len(self.late[4]) + np.cumsum(n) - n
        # The ids stay where they are; only the rows that tell where they lie are put in order.
        order = np.argsort(one[rows], kind="stable")
        rows = rows[order]
        place = np.searchsorted(self.late[0], one[rows])
        added = one[rows], two[rows], begin[order], n[order]
        self.late = *(np.insert(held, place, x) for held, x in zip(self.late, added)), ids

    def encode_block(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``(bounds, ids)`` of texts laid end to end; every text ends with ``end_id``."""
        n_docs = len(offsets) - 1
        if not self.cuts:
            texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
            rows = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            per_doc = np.array([len(x) for x in rows], np.int64)
            ids = np.array([i for x in rows for i in x], self.width)
        else:
            starts = piece_starts(data, offsets)
            ends = np.append(starts[1:], len(data))
            one, two = (word_hashes(data, starts, ends, c) for c in _CODES)
            key, first, which = np.unique(one, return_index=True, return_inverse=True)
            if (two[first][which] != two).any():
                # Two pieces with one first hash: encode this block by itself, by both hashes.
                return self._apart(data, offsets, end_id)
            self._learn(key, two[first], lambda i: [data[starts[j]: ends[j]].tobytes().decode() for j in first[i].tolist()])
            at = find(self.late[0], key)
            if (self.late[1][at] != two[first]).any():
                return self._apart(data, offsets, end_id)
            n, ids = self._gather(self.late, at[which])
            cut = np.searchsorted(starts, offsets)
            total = np.concatenate(([0], np.cumsum(n)))
            per_doc = total[cut[1:]] - total[cut[:-1]]
        bounds = np.concatenate(([0], np.cumsum(per_doc + 1)))
        out = np.empty(len(ids) + n_docs, self.width)
        out[np.arange(len(ids)) + np.repeat(np.arange(n_docs), per_doc)] = ids
        out[bounds[1:] - 1] = end_id
        return bounds, out

    def _apart(self, data, offsets, end_id):
        """The block without the memory of pieces, in which a first hash stands for one piece."""
        cuts, self.cuts = self.cuts, False
        try:
            return self.encode_block(data, offsets, end_id)
        finally:
            self.cuts = cuts

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        data, offsets = text_bytes(pa.array(texts, pa.large_string()))
        bounds, ids = self.encode_block(data, offsets, end_id)
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def _encode(tokenizer_path: str, end_id: int, key: str, bounds: np.ndarray):
    def run(batches):
        enc, squeeze = PieceEncoder.shared(tokenizer_path), zstandard.ZstdCompressor(1)
        for batch in batches:
            at = batch.schema.get_field_index
            keys = batch.column(at(key)).fill_null(NULL_KEY).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = text_bytes(batch.column(at("text")))
            for lo, hi in doc_blocks(offsets, BLOCK_BYTES):
                part = offsets[lo: hi + 1]
                edge, ids = enc.encode_block(data[part[0]: part[-1]], part - part[0], end_id)
                k = keys[lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.searchsorted(bounds, k, "right").astype(np.int32)), pa.array(k), pa.array(np.diff(edge), pa.int64()),
                     pa.array([squeeze.compress(ids[a:b].tobytes()) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.binary())],
                    names=["shard", "key", "n", "ids"])
        give_back()

    return run


# --- shards ----------------------------------------------------------------

SHARD = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("width", T.IntegerType()),
    T.StructField("n_docs", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("first_key", T.LongType()), T.StructField("last_key", T.LongType()),
    T.StructField("payload", T.BinaryType()), T.StructField("bounds", T.BinaryType()),
    T.StructField("mph", T.BinaryType()), T.StructField("slots", T.BinaryType()),
])
SLOT = np.dtype([("fingerprint", "<u8"), ("row", "<u4"), ("rows", "<u4")])


def _shard_row(shard, part, width, keys, sizes, payload):
    keys = np.array(keys, np.int64)
    distinct, first, rows = np.unique(keys, return_index=True, return_counts=True)
    mph, at = build_mph(distinct)
    slots = np.empty(len(distinct), SLOT)
    slots["fingerprint"][at], slots["row"][at], slots["rows"][at] = fingerprint(distinct), first, rows
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype("<i8")
    values = [shard, part, width, len(keys), int(bounds[-1]), int(keys[0]), int(keys[-1]),
              b"".join(payload), bounds.tobytes(), mph, slots.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f) for v, f in zip(values, _ARROW)], names=SHARD.names)


_ARROW = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 4]


def _pack(width: int, shard_bytes: int):
    """Sorted rows (shard, key, n, ids) to shard rows of at most about ``shard_bytes`` of ids."""

    def run(batches):
        grow = zstandard.ZstdDecompressor()
        now, part, keys, sizes, payload, held = None, 0, [], [], [], 0
        for batch in batches:
            for s, k, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if keys and (s != now or held >= shard_bytes):
                    yield _shard_row(now, part, width, keys, sizes, payload)
                    part = part + 1 if s == now else 0
                    keys, sizes, payload, held = [], [], [], 0
                elif s != now:
                    part = 0
                now = s
                keys.append(k)
                sizes.append(n)
                payload.append(grow.decompress(ids, max_output_size=n * width))
                held += n * width
        if keys:
            yield _shard_row(now, part, width, keys, sizes, payload)

    return run


def range_bounds(keys: DataFrame, key: str, n_ranges: int) -> np.ndarray:
    """Keys that cut ``keys`` into about ``n_ranges`` ranges alike, from a sample of ``KEYS_PER_RANGE`` keys each."""
    if n_ranges < 2:
        return np.empty(0, np.int64)
    keys = keys.select(key).filter(F.col(key).isNotNull())
    total = keys.count()
    share = min(1.0, n_ranges * KEYS_PER_RANGE / max(1, total))
    some = keys if share == 1.0 else keys.sample(share, seed=1)
    found = np.sort(some.toArrow().column(0).to_numpy().astype(np.int64))  # 8 bytes each, 160 a range
    return np.unique(found[np.arange(1, n_ranges) * len(found) // n_ranges]) if len(found) else found


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, key: str = "doc_id",
                 shard_bytes: int = 8 << 20, range_bytes: int = 2 << 20) -> None:
    """Encode ``docs.text`` and write shards under ``path/shards`` and the directory
    under ``path/directory``.  Shards follow each other in ascending key.

    Keys are cut into ranges of about ``range_bytes`` of text, as many as the text asks for (the driver holds 160 bytes a
    range while it cuts them); only a key that repeats can make a range larger.
    """
    spark = docs.sparkSession
    ship(spark)
    from tokenizers import Tokenizer

    width = 2 if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else 4
    docs = docs.select(F.col(key).cast("long").alias(key), "text")
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_ranges = partitions_for(n_bytes, range_bytes)
    bounds = range_bounds(docs, key, n_ranges)
    rows = docs.mapInArrow(_encode(tokenizer_path, end_id, key, bounds), "shard int, key long, n long, ids binary")
    # Several ranges a task, so that tasks come out alike however the ranges are dealt.
    shards = (rows.repartition(-(-n_ranges // RANGES_PER_TASK), "shard").sortWithinPartitions("shard", "key", "n", "ids")
              .mapInArrow(_pack(width, shard_bytes), SHARD))
    shards.write.option("compression", "zstd").parquet(f"{path}/shards")
    heads = spark.read.parquet(f"{path}/shards").select("shard", "part", "n_docs", "n_ids", "first_key", "last_key")
    # One row per shard of some MB: a running sum over them is small whatever the corpus.
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    heads.withColumn("ids_before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long")) \
        .coalesce(1).write.parquet(f"{path}/directory")


PLACE = "key long, shard int, part int, row int, start long, n_ids long"


def locate_tokens(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keyed access to the index: ``PLACE`` of every stored row whose key is in ``keys``.

    The directory (one row per shard of some MB) maps a key to its shards; within the shard the perfect
    hash and the fingerprint find the row.  No id payload is read.
    """
    ship(spark)
    directory = spark.read.parquet(f"{path}/directory").orderBy("shard", "part").collect()
    # The shards' last keys cut the key line into slices; a shard meets the keys of its slices.
    ends = np.unique(np.array([r["last_key"] for r in directory], np.int64))

    def slice_of(batches):
        for b in batches:
            k = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(ends, k, "left")), pa.array(k)], names=["slice", "key"])

    asked = (keys.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY)).alias("key")).distinct()
             .mapInArrow(slice_of, "slice long, key long"))
    spans = [(int(r["shard"]), int(r["part"]), int(r["ids_before"]), int(np.searchsorted(ends, r["first_key"], "left")),
              int(np.searchsorted(ends, r["last_key"], "left"))) for r in directory]
    heads = spark.createDataFrame(spans, "shard int, part int, ids_before long, lo long, hi long")
    index = spark.read.parquet(f"{path}/shards").select("shard", "part", "mph", "slots", "bounds").join(heads, ["shard", "part"]) \
        .withColumn("slice", F.explode(F.sequence("lo", "hi"))).drop("lo", "hi")
    packed = asked.groupBy("slice").agg(F.collect_list("key").alias("keys"))  # at most the keys of one shard

    def find_rows(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                table, edge, wanted = np.frombuffer(r["slots"], SLOT), np.frombuffer(r["bounds"], "<i8"), np.array(r["keys"], np.int64)
                at = Mph(r["mph"]).slots(wanted)
                ok = at >= 0
                ok[ok] = table["fingerprint"][at[ok]] == fingerprint(wanted)[ok]
                first, rows = table["row"][at[ok]].astype(np.int64), table["rows"][at[ok]].astype(np.int64)
                row = np.repeat(first, rows) + np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows)
                n = len(row)
                out.append([np.repeat(wanted[ok], rows), np.full(n, r["shard"]), np.full(n, r["part"]), row,
                            r["ids_before"] + edge[row], edge[row + 1] - edge[row]])
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(cols, ("i8", "i4", "i4", "i4", "i8", "i8"))],
                                             names=["key", "shard", "part", "row", "start", "n_ids"])

    return index.join(packed, "slice").select("shard", "part", "mph", "slots", "bounds", "ids_before", "keys").mapInArrow(find_rows, PLACE)


def _null_key(df: DataFrame) -> DataFrame:
    return df.withColumn("key", F.when(F.col("key") != NULL_KEY, F.col("key")))


def lookup_tokens(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, start, n_ids, ids)`` for every stored row whose key is in ``keys``: ids as written, little-endian."""
    places = locate_tokens(spark, path, keys, key).groupBy("shard", "part").agg(  # at most the rows of one shard
        F.collect_list(F.struct("key", "row", "start", "n_ids")).alias("rows"))
    shards = spark.read.parquet(f"{path}/shards").select("shard", "part", "width", "payload", "bounds")

    def cut(batches):
        for b in batches:
            for r in b.to_pylist():
                edge, w = np.frombuffer(r["bounds"], "<i8"), r["width"]
                rows = r["rows"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["key"] for x in rows], pa.int64()), pa.array([x["start"] for x in rows], pa.int64()),
                     pa.array([x["n_ids"] for x in rows], pa.int64()),
                     pa.array([r["payload"][edge[x["row"]] * w: edge[x["row"] + 1] * w] for x in rows], pa.binary())],
                    names=["key", "start", "n_ids", "ids"])

    found = shards.join(places, ["shard", "part"]).select("width", "payload", "bounds", "rows")
    return _null_key(found.mapInArrow(cut, "key long, start long, n_ids long, ids binary"))


def token_digests(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per stored row, from the files by key: ids before it, number of ids, CRC-32 of its ids as 32-bit
    integers.  The payload is read once where it lies; only checksums meet the index."""
    def checksums(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = np.frombuffer(r["payload"], f"<u{r['width']}")
                edge = np.frombuffer(r["bounds"], "<i8").tolist()
                crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(edge[:-1], edge[1:])]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, r["shard"], "i4")), pa.array(np.full(n, r["part"], "i4")), pa.array(np.arange(n, dtype="i4")),
                     pa.array(crc, pa.int64())], names=["shard", "part", "row", "ids_crc32"])

    sums = spark.read.parquet(f"{path}/shards").select("shard", "part", "width", "payload", "bounds").mapInArrow(
        checksums, "shard int, part int, row int, ids_crc32 long")
    found = locate_tokens(spark, path, keys, key).join(sums, ["shard", "part", "row"])
    return _null_key(found).select(F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")


def encode_and_read(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as token shards in the shared folder; return their digests read back by key."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id)
    return token_digests(spark, path, docs)


FILES_AT_ONCE = 200_000  # rows (about 150 bytes each) of a table of files that may be broadcast


def in_stored_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``position``, 0-based: the place of each row in its Parquet files, files by their part number
    and rows as they lie in a file.  A frame that isn't read straight from Parquet files is stored first.

    Rows are not moved: a file's rows are counted, and each file gets the number of rows before it.
    """
    names = docs.columns
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_tk_file"), F.col("_metadata.row_index").alias("_tk_row"))
    except AnalysisException:  # not read from Parquet
        return in_stored_order(stored(docs, "tokens-input"))
    number = F.coalesce(F.regexp_extract("_tk_file", r"part-(\d+)[^/]*$", 1).try_cast("long"), F.lit(0).cast("long"))
    files = placed.groupBy("_tk_file").agg(F.count(F.lit(1)).alias("n")).withColumn("number", number)
    before = Window.orderBy("number", "_tk_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = stored(files.select("_tk_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_tk_base")), "tokens-files")
    if files.count() <= FILES_AT_ONCE:
        files = F.broadcast(files)
    return placed.join(files, "_tk_file").select(*names, (F.col("_tk_base") + F.col("_tk_row")).alias("position"))


def encode_in_order(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as token shards in the order they are stored in; the key of a row is its position there, so
    a document that is stored several times is written at each of its places.

    Returns per stored row, read back by position: doc_id, start, n_tokens, ids_crc32, position.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    placed = in_stored_order(docs.select("doc_id", "text"))
    write_tokens(placed, path, tokenizer_path, end_id, key="position")
    found = token_digests(spark, path, placed, "position").withColumnRenamed("doc_id", "position")
    return placed.select("position", "doc_id").join(found, "position").select("doc_id", "start", "n_tokens", "ids_crc32", "position")
