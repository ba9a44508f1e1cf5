"""Merkle manifest of a table: subroots per source, one root, a proof per document, and versions.

Every row is a leaf, the hash of its fields.  Leaves of a source ascend by ``doc_id``; every ``ARITY``
consecutive nodes become their hash until one is left, the source's subroot; the subroots, by
source, make the root in the same way.

The tree is built in layers of aligned blocks: ``ARITY ** LEVELS`` consecutive nodes are one block, a block
is built by one task, and block roots are the nodes of the next layer.  A block is a persistent
tree: changing a leaf makes a new version that copies the leaf's ancestors in the block and shares all
other nodes.  The version's block root goes on through the layers above by the block's path there,
in the task that holds the block: each layer's paths are joined down to its blocks, so the upper part of
all versions is as distributed as the leaves are.

Leaf positions need no one-task numbering: leaves are range-sorted by (source, doc_id, leaf), numbered in
each range, and ranges get their base from a running sum over the ranges of a source.  Equal rows
are one row with a count until they are numbered, so a repeated key spreads over blocks.

Digests are lowercase hex SHA-256 over concatenated inputs, digests as hex text.

Defined results: a null field is hashed as ``-``; a null ``doc_id`` comes first, a null source too; rows with
the same source and ``doc_id`` are ordered by leaf, then by their changed leaf; equal rows are leaves of their
own; an empty table has no row; other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranges import RANGE_BYTES, positions
from .ship import ship, stored
from .sqltext import CRC_TABLE, crc32_of

ARITY = 3
LEVELS = 7           # levels of a block: 2 187 nodes
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts: bytes) -> bytes:
    """The hash of the inputs put together, as hex text."""
    return sha256(b"".join(parts)).hexdigest().encode()


def field_hash(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 over the fields: ``-`` for null, else byte count, ``:`` and the value."""
    parts = []
    for c in columns:
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


class PersistentBlock:
    """A tree over some consecutive nodes, whose versions share what they do not change.

    Nodes are rows of three lists (digest, kids, level by level); a version appends the copied
    ancestors of one leaf and leaves every other node where it is.
    """

    def __init__(self, leaves: list[bytes], levels: int | None = None, arity: int = ARITY):
        """``levels``: so many, also over a lone node (a block of a larger tree); None: until one node is left."""
        self.arity, self.digests, self.kids = arity, list(leaves), [()] * len(leaves)
        row, height = list(range(len(leaves))), 0
        while (len(row) > 1) if levels is None else (height < levels):
            row = [self._node(tuple(row[i: i + arity])) for i in range(0, len(row), arity)]
            height += 1
        self.root, self.height, self.size = row[0], height, len(leaves)

    def _node(self, kids: tuple[int, ...]) -> int:
        self.kids.append(kids)
        self.digests.append(digest(*[self.digests[k] for k in kids]))
        return len(self.digests) - 1

    def _path(self, leaf: int) -> list[tuple[int, int]]:
        """``(node, which kid)`` from the root down to the leaf's parent."""
        node, out, width = self.root, [], self.arity ** (self.height - 1) if self.height else 1
        for _ in range(self.height):
            k = leaf // width
            out.append((node, k))
            node, leaf, width = self.kids[node][k], leaf % width, width // self.arity or 1
        return out

    def version(self, leaf: int, value: bytes) -> int:
        """The root of a version with another leaf: ancestors are copied, all else is shared."""
        self.kids.append(())
        self.digests.append(value)
        new = len(self.digests) - 1
        for node, k in reversed(self._path(leaf)):
            kids = self.kids[node]
            new = self._node((*kids[:k], new, *kids[k + 1:]))
        return new

    def forget(self, keep: int) -> None:
        """Drop the nodes of versions made since the store had ``keep`` nodes."""
        del self.digests[keep:], self.kids[keep:]

    def siblings(self, leaf: int) -> list[tuple[bytes, bytes]]:
        """Per level, from the leaf up: digests before it in its run, and after it."""
        out = []
        for node, k in reversed(self._path(leaf)):
            kids = [self.digests[x] for x in self.kids[node]]
            out.append((b"".join(kids[:k]), b"".join(kids[k + 1:])))
        return out


def fold(value: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that ``value`` has under the given siblings."""
    for before, after in path:
        value = digest(before, value, after)
    return value


def path_text(path: list[tuple[bytes, bytes]]) -> str:
    return ",".join(f"{a.decode()}.{b.decode()}" for a, b in path)


def path_of(text: str) -> list[tuple[bytes, bytes]]:
    return [tuple(x.encode() for x in level.split(".")) for level in text.split(",")] if text else []


def _blocks_of(batches):
    """Rows sorted by (tree, block, position), streamed as ``(head, rows)`` of a block; ``head`` is its row at -1, if any."""
    key, head, rows = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["tree"], row["block"]) != key:
                if rows:
                    yield head, rows
                key, head, rows = (row["tree"], row["block"]), None, []
            if row["pos"] < 0:
                head = row
            else:
                rows.append(row)
    if rows:
        yield head, rows


def _tree_of(rows: list[dict], levels: int, arity: int) -> PersistentBlock:
    whole = rows[0]["size"] <= arity**levels  # the tree ends in this block
    return PersistentBlock([r["node"].hex().encode() for r in rows], None if whole else levels, arity)


ROOTS = "tree string, pos long, node binary"


def _block_roots(levels: int, arity: int):
    def run(batches):
        for _, rows in _blocks_of(batches):
            tree = _tree_of(rows, levels, arity)
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[0]["tree"]], pa.string()), pa.array([rows[0]["block"]], pa.int64()),
                pa.array([bytes.fromhex(tree.digests[tree.root].decode())], pa.binary())], names=["tree", "pos", "node"])
    return run


def _block_paths(levels: int, arity: int):
    """Each node of an upper layer with its siblings up to its tree's root, and that root."""
    def run(batches):
        for head, rows in _blocks_of(batches):
            tree = _tree_of(rows, levels, arity)
            above = path_of(head["above"])
            yield pa.RecordBatch.from_arrays([
                pa.array([r["tree"] for r in rows], pa.string()), pa.array([r["pos"] for r in rows], pa.int64()),
                pa.array([path_text(tree.siblings(i) + above) for i in range(len(rows))], pa.string()),
                pa.array([head["root"]] * len(rows), pa.binary())], names=["tree", "pos", "path", "root"])
    return run


LEAVES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("pos", T.LongType()),
    T.StructField("leaf", T.StringType()), T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType()),
    T.StructField("proof_sha256", T.StringType()), T.StructField("n_siblings", T.LongType()),
    T.StructField("folded_root", T.StringType()), T.StructField("n_copied", T.LongType()), T.StructField("verified", T.BooleanType()),
])


def _verify(levels: int, arity: int):
    """Leaf blocks with the path above each: proofs, and the root of each leaf's version."""
    def run(batches):
        for head, rows in _blocks_of(batches):
            tree, above = _tree_of(rows, levels, arity), path_of(head["above"])
            subroot, root = head["subroot"].hex(), head["root"].hex()
            made, out = len(tree.digests), []
            for i, r in enumerate(rows):
                leaf, shown = r["node"].hex().encode(), r["shown"].hex().encode()
                path = tree.siblings(i) + above
                if r["changed"]:
                    top = fold(tree.digests[tree.version(i, shown)], above)
                    copied = len(tree.digests) - made - 1 + len(above)
                    tree.forget(made)
                else:
                    top, copied = fold(shown, path), 0
                joined, top = b"".join(a + b for a, b in path), top.decode()
                out.append((r["doc_id"], r["source"], r["pos"], leaf.decode(), subroot, root, sha256(joined).hexdigest(),
                            len(joined) // 64, top, copied, top == root))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(),
                pa.int64(), pa.bool_()))], names=LEAVES.names)
    return run


def _sorted_blocks(nodes: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """Rows with ``tree, block, pos``, dealt out by block and sorted for ``_blocks_of``; ``heads`` has a row per block."""
    if heads is not None:
        nodes = nodes.unionByName(heads.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _block(width: int) -> Column:
    return F.floor(F.col("pos") / width).cast("long").alias("block")


def _paths(nodes: DataFrame, levels: int, arity: int) -> DataFrame:
    """``nodes``: (tree, pos, node), a layer.  Returns (tree, pos, path, root): each node's siblings up to its
    tree's root, and that root.  Layers above are found by the same step over the block roots."""
    width = arity**levels
    sizes = nodes.groupBy("tree").agg(F.max("pos").alias("last"))
    nodes = stored(nodes.join(sizes, "tree").select("tree", "pos", "node", (F.col("last") + 1).alias("size"), _block(width)), "merkle-layer")
    roots = stored(_sorted_blocks(nodes).mapInArrow(_block_roots(levels, arity), ROOTS), "merkle-roots")
    largest = nodes.agg(F.max("size")).first()[0] or 0
    if largest <= width:  # one block per tree: its root is the tree's
        heads = roots.select("tree", F.col("pos").alias("block"), F.lit("").alias("above"), F.col("node").alias("root"))
    else:
        heads = _paths(roots, levels, arity).select("tree", F.col("pos").alias("block"), F.col("path").alias("above"), "root")
    return stored(_sorted_blocks(nodes, heads).mapInArrow(_block_paths(levels, arity), "tree string, pos long, path string, root binary"), "merkle-paths")


def manifest(leaves: DataFrame, levels: int = LEVELS, arity: int = ARITY, range_bytes: float = RANGE_BYTES) -> DataFrame:
    """The manifest of ``leaves``: (doc_id, source, leaf hex, shown hex), where ``shown`` is the leaf that
    is to be verified.

    Returns doc_id, source, pos, leaf, subroot, root, proof_sha256, n_siblings, folded_root (of ``shown`` under the
    original siblings), n_copied (nodes its version copied; 0 where the leaf is unchanged) and verified.
    """
    ship(leaves.sparkSession)
    # A source as the name of its tree: never null, and ordered like the sources, null first.
    name = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("source")))
    slim = leaves.select(name.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex("leaf").alias("node"), F.unhex("shown").alias("shown"))
    placed = stored(positions(slim, ["doc_id", "node", "shown"], range_bytes).withColumn("block", _block(arity**levels)), "merkle-placed")
    roots = _sorted_blocks(placed.select("tree", "block", "pos", "size", "node")).mapInArrow(_block_roots(levels, arity), ROOTS)
    in_source = _paths(stored(roots, "merkle-roots"), levels, arity)  # of each block of leaves
    # Subroots are the leaves of the last tree, in the order of their sources.
    subroots = in_source.filter(F.col("pos") == 0).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"))
    subroots = stored(positions(subroots, ["name", "node"], range_bytes), "merkle-subroots")
    tops = _paths(subroots.select("tree", "pos", "node"), levels, arity).select("pos", F.col("path").alias("top_path"), "root")
    tops = subroots.join(tops, "pos").select(F.col("name").alias("tree"), "top_path", F.col("node").alias("subroot"), "root")
    heads = in_source.drop("root").join(tops, "tree").select(
        "tree", F.col("pos").alias("block"), "subroot", "root",
        F.concat_ws(",", F.nullif("path", F.lit("")), F.nullif("top_path", F.lit(""))).alias("above"))
    rows = placed.withColumn("source", F.when(F.col("tree") != "0", F.substring("tree", 2, 2**31 - 1))).withColumn(
        "changed", F.col("node") != F.col("shown"))
    return _sorted_blocks(rows, heads).mapInArrow(_verify(levels, arity), LEAVES)


def with_tampered(documents: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, shown) of ``documents``: where 2 divides the CRC-32 of the decimal ``doc_id``, the
    shown leaf is that of a text without its line feeds.  A null ``doc_id`` is left alone."""
    def leaf(text: Column) -> Column:
        return field_hash([text if c == "text" else F.col(c) for c in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return documents.select("doc_id", "source", leaf(F.col("text")).alias("leaf"), F.when(
        hit & F.contains("text", F.lit("\n")), leaf(F.replace("text", F.lit("\n"), F.lit("")))).alias("other")).select(
        "doc_id", "source", "leaf", F.coalesce("other", "leaf").alias("shown"))


def manifest_report(documents: DataFrame) -> DataFrame:
    """The manifest of ``documents``, with the leaves of ``with_tampered`` shown."""
    return manifest(with_tampered(documents))


#: The manifest in DuckDB: levels of all trees, siblings by level, and the fold of what is shown.
MANIFEST_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, fields AS (
  SELECT doc_id, source, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    {crc32_of('CAST(doc_id AS VARCHAR)')} % 2 = 0 AS hit
  FROM documents, crc_table
), hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, hit, head,
    replace(text, chr(10), '') AS cut FROM fields
), leaves AS (
  SELECT doc_id, source, leaf, CASE WHEN hit THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) ELSE leaf END AS shown,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed
), lower_nodes AS (
  SELECT source, 0 AS lvl, pos, leaf AS node, count(*) OVER (PARTITION BY source) AS size FROM leaves
  UNION ALL
  SELECT source, lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(size) + 2) // 3
  FROM lower_nodes WHERE size > 1 GROUP BY source, lvl, pos // 3
), subroots AS (
  SELECT source, node AS subroot, lvl AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM lower_nodes WHERE size = 1
), upper_nodes AS (
  SELECT 0 AS lvl, pos, subroot AS node, (SELECT count(*) FROM subroots) AS size FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(size) + 2) // 3
  FROM upper_nodes WHERE size > 1 GROUP BY lvl, pos // 3
), steps AS (
  SELECT l.doc_id, l.source, l.pos AS p, n.lvl, coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos < l.pos // CAST(power(3, n.lvl) AS BIGINT)), '') AS a,
    coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos > l.pos // CAST(power(3, n.lvl) AS BIGINT)), '') AS b
  FROM leaves l JOIN lower_nodes n ON n.source IS NOT DISTINCT FROM l.source AND n.size > 1
    AND n.pos // 3 = l.pos // CAST(power(3, n.lvl + 1) AS BIGINT)
  GROUP BY ALL
  UNION ALL
  SELECT l.doc_id, l.source, l.pos, s.height + n.lvl, coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos < s.pos // CAST(power(3, n.lvl) AS BIGINT)), ''),
    coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos > s.pos // CAST(power(3, n.lvl) AS BIGINT)), '')
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
  JOIN upper_nodes n ON n.size > 1 AND n.pos // 3 = s.pos // CAST(power(3, n.lvl + 1) AS BIGINT)
  GROUP BY ALL
), folded AS (
  SELECT doc_id, source, pos AS p, 0 AS lvl, shown AS node FROM leaves
  UNION ALL
  SELECT f.doc_id, f.source, f.p, f.lvl + 1, sha256(s.a || f.node || s.b)
  FROM folded f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.p = f.p AND s.lvl = f.lvl
), proofs AS (
  SELECT source, p, sha256(string_agg(a || b, '' ORDER BY lvl)) AS proof_sha256, CAST(sum(strlen(a || b)) // 64 AS BIGINT) AS n_siblings, max(lvl) + 1 AS height
  FROM steps GROUP BY source, p
)
SELECT l.doc_id, l.source, CAST(l.pos AS BIGINT) AS pos, l.leaf, s.subroot, r.node AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
  coalesce(p.n_siblings, 0) AS n_siblings, f.node AS folded_root, CAST(CASE WHEN l.leaf = l.shown THEN 0 ELSE coalesce(p.height, 0) END AS BIGINT) AS n_copied,
  f.node = r.node AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
JOIN (SELECT node FROM upper_nodes WHERE size = 1) r ON true
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM l.source AND p.p = l.pos
JOIN folded f ON f.source IS NOT DISTINCT FROM l.source AND f.p = l.pos AND f.lvl = coalesce(p.height, 0)
"""
