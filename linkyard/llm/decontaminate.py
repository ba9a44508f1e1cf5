"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items build one automaton per bounded block of items.
Each document's words stream through it; the length of the longest match that
ends at a word tells which benchmark windows end there.  A window is ``window``
consecutive words of an item, or a shorter item as a whole.

Defined results: null or wordless texts have no words and are clean; repeated
rows are judged one by one; an empty benchmark leaves everything clean; other
columns pass through (their names must not start with ``_bd_``).
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranges import running_sums
from .ship import ship, stored
from .textual import ALNUM, doc_blocks, find, per_doc, text_bytes, word_bounds, word_hashes

BLOCK_WORDS = 200_000  # about 1 KB of automaton a word, in each worker

HITS = T.StructType([
    T.StructField("_bd_words", T.LongType()),
    T.StructField("_bd_from", T.ArrayType(T.LongType())),   # hit word ranges [from, to), ascending, disjoint
    T.StructField("_bd_to", T.ArrayType(T.LongType())),
    T.StructField("_bd_byte_from", T.ArrayType(T.LongType())),
    T.StructField("_bd_byte_to", T.ArrayType(T.LongType())),
    T.StructField("_bd_items", T.ArrayType(T.StringType())),
])


class SuffixAutomaton:
    """A generalised suffix automaton over sequences of word numbers."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.items: list[set[int]] = [set()]
        self.whole: list[list[tuple[int, int]]] = [[]]  # (length, item) of short items that end in this state

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.items.append(set())
        self.whole.append([])
        return len(self.length) - 1

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, q, c)
        cur = self._state(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, c)
        return cur

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._state(self.length[p] + 1)
        self.next[clone] = dict(self.next[q])
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def build(self, items: list[tuple[int, list[int]]]) -> "SuffixAutomaton":
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        for n, words in items:  # second walk: which items pass each state
            at = 0
            for w in words:
                at = self.next[at][w]
                p = at
                while p > 0 and n not in self.items[p]:
                    self.items[p].add(n)
                    p = self.link[p]
            if 0 < len(words) < self.window:
                self.whole[at].append((len(words), n))
        # A short item also ends wherever a state has it as a suffix.
        for p in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.whole[p] = self.whole[p] + self.whole[self.link[p]]
        return self

    def hits(self, words: list[int]) -> list[tuple[int, int, int]]:
        """``(end, length, item)`` of each window of an item that ends before word ``end``."""
        nxt, link, length, w = self.next, self.link, self.length, self.window
        out, at, run = [], 0, 0
        for i, c in enumerate(words):
            while at and c not in nxt[at]:
                at = link[at]
                run = length[at]
            if c in nxt[at]:
                at = nxt[at][c]
                run += 1
            if run >= w:
                p = at
                while length[link[p]] >= w:
                    p = link[p]
                out += [(i + 1, w, n) for n in self.items[p]]
            if self.whole[at]:
                out += [(i + 1, m, n) for m, n in self.whole[at] if m <= run]
        return out


ITEMS = T.StructType([T.StructField("item", T.StringType()), T.StructField("part", T.LongType()), T.StructField("n", T.LongType()),
                      T.StructField("words", T.BinaryType())])


def _hash_items(window: int, most: int):
    """Items to the hashes of their words; an item of over ``most`` words in parts that share ``window - 1`` words."""
    def run(batches):
        for batch in batches:
            names = ["" if i is None else str(i) for i in batch.column(0).to_pylist()]
            data, off = text_bytes(batch.column(1))
            for lo, hi in doc_blocks(off):
                part = data[off[lo]: off[hi]]
                s, e, d = word_bounds(part, off[lo: hi + 1] - off[lo], ALNUM)
                h, first, rows = word_hashes(part, s, e), per_doc(d, hi - lo), []
                for i in range(hi - lo):
                    words = h[first[i]: first[i + 1]]
                    if len(words):
                        rows += [(names[lo + i], k, x) for k, a in enumerate(range(0, max(1, len(words) - window + 1), most - window + 1))
                                 if len(x := words[a: a + most])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([len(r[2]) for r in rows], pa.int64()), pa.array([r[2].tobytes() for r in rows], pa.binary())], names=ITEMS.names)
    return run


def benchmark_items(benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """``(item, part, n, words, block)``, stored: the hashed items, dealt to blocks of at most ``block_words``
    words (twice that with the item that ends a block) by a running sum of their sizes."""
    ship(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(_hash_items(window, max(block_words, 2 * window)), ITEMS)
    items = stored(items.withColumn("h", F.xxhash64("words")).dropDuplicates(["item", "part", "n", "h"]), "benchmark-items")
    placed = running_sums(items.select(F.lit("").alias("tree"), "item", "part", F.col("n").alias("size"), "h"), ["item", "part", "size", "h"], "size")
    blocks = placed.select("item", "part", "h", F.floor(F.col("before") / block_words).cast("long").alias("block"))
    return stored(items.join(blocks, ["item", "part", "h"]).drop("h"), "benchmark-blocks")


def _scan(block, window: int, text_column: str):
    """The function that adds this block's hits to every row of Arrow batches."""
    vocab = np.unique(np.concatenate([w for _, w in block])) if block else np.empty(0, np.uint64)
    names = [i for i, _ in block]
    sequences = [(n, find(vocab, w).tolist()) for n, (_, w) in enumerate(block)]
    shortest = min([window, *(len(w) for _, w in block)])

    def run(batches):
        sam = SuffixAutomaton(window).build(sequences)
        near = np.zeros(1 << 20, bool)
        near[(vocab >> np.uint64(44)).astype(np.int64)] = True
        for batch in batches:
            yield _add_hits(batch, sam, vocab, near, shortest, names, text_column)

    return run


def _add_hits(batch, sam, vocab, near, shortest, names, text_column):
    data, off = text_bytes(batch.column(batch.schema.get_field_index(text_column)))
    rows = []
    for lo, hi in doc_blocks(off):
        part = data[off[lo]: off[hi]]
        s, e, d = word_bounds(part, off[lo: hi + 1] - off[lo], ALNUM)
        first = per_doc(d, hi - lo)
        found = defaultdict(list)
        if len(s) and len(vocab):
            h = word_hashes(part, s, e)
            ids = np.full(len(h), -1, np.int64)
            maybe = np.flatnonzero(near[(h >> np.uint64(44)).astype(np.int64)])
            ids[maybe] = find(vocab, h[maybe])
            known = ids >= 0
            fresh = np.ones(len(d), bool)
            fresh[1:] = d[1:] != d[:-1]
            # Runs of known words within one document, as long as the shortest window.
            begin = np.flatnonzero(known & (fresh | ~np.concatenate(([False], known[:-1]))))
            stop = np.flatnonzero(known & np.concatenate((fresh[1:] | ~known[1:], [True]))) + 1
            long = stop - begin >= shortest
            for a, b in zip(begin[long].tolist(), stop[long].tolist()):
                if hits := sam.hits(ids[a:b].tolist()):
                    found[int(d[a])] += [(a + end - m, a + end, n) for end, m, n in hits]
        for i in range(hi - lo):
            base, at = int(first[i]), int(off[lo + i] - off[lo])
            rows.append((int(first[i + 1] - base), [(a - base, b - base, int(s[a]) - at, int(e[b - 1]) - at, names[n])
                                                    for a, b, n in found.get(i, ())]))
    old = batch.schema.get_field_index("_bd_words")
    earlier = [None] * len(rows)
    keep = batch
    if old >= 0:
        cols = ["_bd_from", "_bd_to", "_bd_byte_from", "_bd_byte_to"]
        earlier = list(zip(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in cols)),
                           batch.column(batch.schema.get_field_index("_bd_items")).to_pylist()))
        keep = batch.select([c for c in batch.schema.names if not c.startswith("_bd_")])
    out = [[] for _ in range(6)]
    for (n_words, hits), before in zip(rows, earlier):
        spans = [h[:4] for h in hits]
        items = {h[4] for h in hits}
        if before is not None:
            spans += list(zip(*before[0]))
            items |= set(before[1])
        merged: list[list[int]] = []
        for a, b, x, y in sorted(spans):
            if merged and a <= merged[-1][1]:
                if b > merged[-1][1]:
                    merged[-1][1], merged[-1][3] = b, y
            else:
                merged.append([a, b, x, y])
        out[0].append(n_words)
        for k in range(4):
            out[k + 1].append([m[k] for m in merged])
        out[5].append(sorted(items))
    longs = pa.list_(pa.int64())
    arrays = [pa.array(out[0], pa.int64()), *(pa.array(out[k], longs) for k in range(1, 5)),
              pa.array(out[5], pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays([*keep.columns, *arrays], names=[*keep.schema.names, *(f.name for f in HITS.fields)])


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS,
                   text_column: str = "text", finish=None, finish_schema=None) -> DataFrame:
    """``docs`` with the columns of ``HITS``.  Each pass holds one automaton of at
    most about twice ``block_words`` benchmark words; a larger benchmark takes more passes,
    each stored before the next.  Items are hashed and dealt to blocks by Spark; the driver passes on one block at a time.  ``finish`` maps the last pass's Arrow batches to batches of
    ``finish_schema`` in the same worker."""
    ship(docs.sparkSession)
    out, schema = docs, T.StructType([*docs.schema.fields, *HITS.fields])
    items = benchmark_items(benchmark, window, block_words)
    numbers = [r[0] for r in items.select("block").distinct().orderBy("block").collect()]  # one a block
    waiting = None
    for number in numbers:
        if waiting is not None:
            out = stored(out.mapInArrow(_scan(waiting, window, text_column), schema), "decontaminate")
        # A block at a time: at most 8 bytes a word, and the items' ids.
        waiting = [(r["item"], np.frombuffer(r["words"], np.uint64)) for r in
                   items.filter(F.col("block") == number).select("item", "words").collect()]
    scan = _scan(waiting or [], window, text_column)
    if finish is None:
        return out.mapInArrow(scan, schema)
    return out.mapInArrow(lambda batches: finish(scan(batches)), finish_schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, **how) -> DataFrame:
    """Per row: ``doc_id``, word and hit counts, the items found and the verdict."""
    hits = benchmark_hits(docs.select("doc_id", "text"), benchmark, window, **how)
    covered = F.aggregate(F.zip_with("_bd_from", "_bd_to", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return hits.select(
        "doc_id", F.col("_bd_words").alias("n_words"), covered.alias("n_hit"),
        F.size("_bd_items").cast("long").alias("n_items"), "_bd_items").select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join(F.array_sort("_bd_items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def remove_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.8, **how) -> DataFrame:
    """``docs`` without benchmark text: every hit span leaves its text (with the
    blanks after it); a document with hits goes if over ``max_coverage`` of its words are hit or
    nothing but blanks is left.  Texts without a hit stay as they are."""
    names = docs.columns

    def cut(batches):
        for batch in batches:
            at = batch.schema.get_field_index
            texts = batch.column(at("text")).to_pylist()
            words, *spans = (batch.column(at(c)).to_pylist() for c in ("_bd_words", "_bd_from", "_bd_to", "_bd_byte_from", "_bd_byte_to"))
            keep, new = [], []
            for i, (text, n, fs, ts, xs, ys) in enumerate(zip(texts, words, *spans)):
                if xs:
                    raw, kept, end = text.encode(), [], 0
                    for x, y in zip(xs, ys):
                        kept.append(raw[end:x])
                        end = y
                    kept.append(raw[end:])
                    text = b" ".join(p for k in kept if (p := k.strip(b" \t"))).decode()
                    if sum(ts) - sum(fs) > max_coverage * n or not text.strip():
                        continue
                keep.append(i)
                new.append(text)
            rows = batch.select(names).take(pa.array(keep, pa.int64()))
            cols = [pa.array(new, rows.schema.field(c).type) if c == "text" else rows.column(k) for k, c in enumerate(names)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return benchmark_hits(docs, benchmark, window, finish=cut, finish_schema=docs.schema, **how)
