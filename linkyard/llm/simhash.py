"""SimHash near-duplicates by tiled exact comparison.

Equal fingerprints are one row from the start.  The distinct fingerprints are dealt to cells
by the bit counts of their two halves; within a cell they are cut into tiles.  Two fingerprints
within ``radius`` bits have half counts that differ by at most ``radius`` together, so
a tile meets only the tiles of cells within that distance, and every such tile pair is
compared in full with exclusive-or and bit counts.  Inside a tile pair, blocks are skipped whose
quarter counts are further apart than the radius.  A tile pair returns the links of a spanning forest, not
every pair, so a group of thousands of near copies stays linear.

Defined results: null, empty and wordless texts have fingerprint zero and are linked like any
other; rows of equal fingerprint share a component; a null ``doc_id`` is never a component's
name unless all its rows have none; an empty table gives an empty result; other columns pass through
``drop_near_copies`` (names must not start with ``_sh_``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components, forest_batches
from .ship import ship, stored

SEED = 42
TILE = 4096


def _bits(hashes: list[int]) -> np.ndarray:
    """Number of hashes that have each bit, most significant first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        h = np.array(hashes[at: at + (1 << 16)], np.uint64).astype(">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return total


def fingerprint_of(text: str | None, shingle: int = 4) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed 64-bit integer."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    hashes = [h(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist())]
    bits = _bits(hashes) * 2 > len(hashes)
    value = int.from_bytes(np.packbits(bits).tobytes(), "big")
    return value - (1 << 64) if value >> 63 else value


def fingerprints(text: str, shingle: int = 4) -> Column:
    """SimHash of a text column as a long."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_py(), shingle) for t in texts], pa.int64())

    return F.arrow_udf(run, T.LongType())(text)


# --- tiles -----------------------------------------------------------------

def _root(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _quarters(x: np.ndarray) -> np.ndarray:
    return np.stack([np.bitwise_count((x >> np.uint64(s)) & np.uint64(0xFFFF)) for s in (0, 16, 32, 48)], axis=1).astype(np.int8)


def _blocks(x: np.ndarray, size: int = 128):
    """``x`` ordered by its quarter counts, cut into blocks with their least and greatest counts."""
    q = _quarters(x)
    order = np.lexsort(q.T)
    x, q = x[order], q[order]
    cut = range(0, len(x), size)
    return x, [(a, min(a + size, len(x)), q[a: a + size].min(0).astype(int), q[a: a + size].max(0).astype(int)) for a in cut]


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Row-column links that keep together whatever the matrix connects: one for each row and column."""
    rows, cols = near.any(axis=1), np.zeros(near.shape[1], bool)
    out = []
    while rows.any():
        new = np.zeros(near.shape[0], bool)
        new[np.argmax(rows)] = True
        while new.any():
            rows &= ~new
            at = np.flatnonzero(new)
            reached = near[at].any(axis=0) & ~cols
            cols |= reached
            js = np.flatnonzero(reached)
            out += zip(at[np.argmax(near[at][:, js], axis=0)].tolist(), js.tolist())
            new = near[:, js].any(axis=1) & rows
            for i in np.flatnonzero(new).tolist():
                out.append((i, int(js[np.argmax(near[i, js])])))
    return out


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two tiles, or within one if ``right`` is None."""
    a, a_blocks = _blocks(left.view(np.uint64))
    b, b_blocks = (a, a_blocks) if right is None else _blocks(right.view(np.uint64))
    nodes = np.concatenate((a, b)) if right is not None else a
    shift = len(a) if right is not None else 0
    parent, links = list(range(len(nodes))), []
    b_lo, b_hi = np.array([x[2] for x in b_blocks]), np.array([x[3] for x in b_blocks])
    for n, (i0, i1, lo, hi) in enumerate(a_blocks):
        # Least possible distance of the counts of two blocks, summed over the quarters.
        apart = np.maximum(0, np.maximum(b_lo - hi, lo - b_hi)).sum(axis=1)
        for m in np.flatnonzero(apart <= radius):
            if right is None and m < n:
                continue
            j0, j1 = b_blocks[m][:2]
            near = np.bitwise_count(a[i0:i1, None] ^ b[None, j0:j1]) <= radius
            if not near.any():
                continue
            for i, j in _forest(near):
                x, y = i0 + i, shift + j0 + j
                p, q = _root(parent, x), _root(parent, y)
                if p != q:
                    parent[p] = q
                    links.append((int(nodes[x].view(np.int64)), int(nodes[y].view(np.int64))))
    return links


def _pack_tiles(tile: int):
    """Rows sorted by cell to tiles: one row of at most ``tile`` fingerprints of one cell."""

    def row(cell, part, values):
        return pa.RecordBatch.from_arrays(
            [pa.array([cell], pa.int32()), pa.array([part], pa.int32()), pa.array([np.array(values, "<i8").tobytes()], pa.binary())],
            names=["cell", "part", "fps"])

    def run(batches):
        now, part, held = None, 0, []
        for batch in batches:
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            values = batch.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1], [True]))) if len(cells) else []
            for a, b in zip(edges[:-1], edges[1:]):
                if cells[a] != now:
                    if held:
                        yield row(now, part, held)
                    now, part, held = int(cells[a]), 0, []
                held += values[a:b].tolist()
                while len(held) >= tile:
                    yield row(now, part, held[:tile])
                    part, held = part + 1, held[tile:]
        if held:
            yield row(now, part, held)

    return run


def _half_counts(fp: Column) -> tuple[Column, Column]:
    low = F.bit_count(fp.bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.bit_count(F.shiftrightunsigned(fp, 32)), low


def near_links(distinct: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Links ``(u, v)`` that connect all fingerprints of ``distinct(fp)`` within ``radius`` bits of each other."""
    spark = distinct.sparkSession
    ship(spark)
    high, low = _half_counts(F.col("fp"))
    cell = (high * 33 + low).cast("int")
    # A cell's tiles are dealt by salt as well, so no task packs a whole cell.
    salt = F.pmod(F.xxhash64("fp"), F.lit(1 + distinct.count() // (64 * tile))).cast("int")
    tiles = (distinct.select(cell.alias("cell"), "fp", salt.alias("salt"))
             .repartition("cell", "salt").sortWithinPartitions("cell").select("cell", "fp")
             .mapInArrow(_pack_tiles(tile), "cell int, part int, fps binary")
             .withColumn("tile", F.concat_ws("-", "cell", "part", F.sha1("fps"))).drop("part"))
    tiles = stored(tiles, "simhash-tiles")
    # Each tile looks for its partners in the cells within the radius: once for each pair of cells.
    steps = [(dh, dl) for dh in range(-radius, radius + 1) for dl in range(-radius, radius + 1)
             if abs(dh) + abs(dl) <= radius and (dh, dl) >= (0, 0)]
    high_of, low_of = F.floor(F.col("cell") / 33), F.col("cell") % 33
    near = F.array(*[F.when((high_of + dh).between(0, 32) & (low_of + dl).between(0, 32),
                            (F.col("cell") + dh * 33 + dl).cast("int")) for dh, dl in steps])
    left = tiles.select(F.col("cell").alias("cell0"), F.col("tile").alias("tile0"), F.col("fps").alias("fps0"),
                        F.explode(F.array_compact(near)).alias("cell"))
    pairs = left.join(tiles, "cell").filter((F.col("cell0") != F.col("cell")) | (F.col("tile0") <= F.col("tile")))

    def compare(batches):
        return forest_batches(tile_links(np.frombuffer(x, "<i8"), None if same else np.frombuffer(y, "<i8"), radius)
                              for batch in batches for same, x, y in zip(*(c.to_pylist() for c in batch.columns)))

    return pairs.select((F.col("tile0") == F.col("tile")).alias("same"), "fps0", "fps").mapInArrow(compare, "u long, v long")


def _components(rows: DataFrame, radius: int) -> DataFrame:
    """``(fp, root)`` for every fingerprint of ``rows(fp, ...)``."""
    distinct = stored(rows.select("fp").distinct(), "simhash-distinct")
    roots = components(near_links(distinct, radius))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, key: str = "doc_id") -> DataFrame:
    """``(key, fingerprint, component_id)`` for every row: 16 hex digits and the smallest key reachable."""
    ship(docs.sparkSession)
    rows = stored(docs.select(F.col(key).alias("_sh_key"), fingerprints("text", shingle).alias("fp")), "simhash")
    of_fp = _components(rows, radius)
    least = rows.groupBy("fp").agg(F.min("_sh_key").alias("least")).join(of_fp, "fp")
    names = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of_fp.join(names, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("_sh_key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 4, radius: int = 4, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: the smallest key's (null last), of equal keys the
    one with the smallest hash of all its columns."""
    ship(docs.sparkSession)
    names = docs.columns
    row_hash = F.xxhash64(F.lit("row"), *names)
    order = F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), row_hash.alias("hash"))
    rows = stored(docs.select(order.alias("row"), fingerprints("text", shingle).alias("fp")), "simhash")
    least = rows.groupBy("fp").agg(F.min("row").alias("row")).join(_components(rows, radius), "fp")
    kept = least.groupBy("root").agg(F.min("row").alias("row")).select(F.col("row.hash").alias("_sh_hash"))
    stay = docs.withColumn("_sh_hash", row_hash).join(kept, "_sh_hash", "left_semi")
    return stay.dropDuplicates(["_sh_hash"]).select(*names)
