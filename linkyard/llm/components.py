"""Connected components of a graph whose edges may share one very hot node.

Large-star and small-star steps in turn (each node's larger, then smaller, neighbours
move to the smallest one), until no edge changes.  Every step is a minimum per node, which
pre-aggregates, and a join back that the adaptive plan can split.  Before a round each task replaces
its edges by a spanning forest of them, so a dense group costs one edge per node and task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ship import partitions_for, ship, stored

EDGE_BYTES = 64
HELD_EDGES = 1 << 20


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges(u, v) with u > v; returns edges to each node's smallest neighbour, itself included."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    moved = both.join(least, both["u"] == least["n"])
    if large:
        moved = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("n").alias("u"), F.col("m").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).distinct()


class Forest:
    """Union-find over integers; each tree's root is its smallest member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        r = x
        while (p := parent.get(r, r)) != r:
            r = p
        while (p := parent.get(x, x)) != r:
            parent[x] = r
            x = p
        return r

    def join(self, x: int, y: int) -> None:
        p, q = self.root(x), self.root(y)
        if p != q:
            self.parent[max(p, q)] = min(p, q)

    def edges(self) -> tuple[list[int], list[int]]:
        nodes = list(self.parent)
        pairs = [(n, r) for n in nodes if (r := self.root(n)) != n]
        return [n for n, _ in pairs], [r for _, r in pairs]


def forest_batches(pairs):
    """Edges ``(u, v)``, a list at a time, to Arrow batches of forest edges."""
    forest = Forest()

    def out():
        u, v = forest.edges()
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for some in pairs:
        for u, v in some:
            forest.join(u, v)
        if len(forest.parent) > HELD_EDGES:
            yield out()
            forest = Forest()
    yield out()


def _contract(batches):
    return forest_batches(zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches)


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, root)`` for every node that has an edge; root is the component's smallest node.

    Each round is stored in the shared checkpoint folder, so the plan stays short
    and a lost executor costs one round at most.
    """
    ship(edges.sparkSession)
    spark = edges.sparkSession
    e = stored(edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).filter(F.col("u") != F.col("v"))
               .mapInArrow(_contract, "u long, v long"), "components")
    last = None
    while (now := _state(e)) != last:
        last = now
        # A few tasks for a few edges, as many as the session shuffles into for many.
        n = partitions_for(now[0] * EDGE_BYTES, 16 << 20, spark.sparkContext.defaultParallelism)
        small = e.coalesce(n).mapInArrow(_contract, "u long, v long")
        e = stored(_star(_star(small, True).coalesce(n), False).coalesce(n), "components")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
