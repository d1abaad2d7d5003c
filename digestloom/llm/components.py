"""Connected components of an edge table, without gathering the graph anywhere.

Each task first replaces its edges by a spanning forest of them. If few edges are left, by a
count, one task reads the components off. Else alternating large-star and small-star rounds
(MapReduce connected components) follow: every node links its larger neighbours to the smallest
node it knows, then its smaller ones, until the edges are stars.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.session import materialise

# Edges that a task may hold: some tens of megabytes.
FOREST_EDGES = 500_000


class Forest:
    """Union-find over numbered nodes."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _forest(batches):
    """Nodes, their forest, the edges and which of them the forest is made of."""
    rows = [pa.Table.from_batches([b]) for b in batches]
    table = pa.concat_tables(rows) if rows else pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    a, b = table.column("a").to_numpy(), table.column("b").to_numpy()
    nodes, number = np.unique(np.concatenate((a, b)), return_inverse=True)
    forest = Forest(len(nodes))
    used = [i for i, (x, y) in enumerate(zip(number[: len(a)].tolist(), number[len(a) :].tolist())) if forest.join(x, y)]
    return nodes, forest, table, used


def _span(batches):
    _, _, table, used = _forest(batches)
    yield from table.take(pa.array(used, pa.int64())).combine_chunks().to_batches()


def _label(batches):
    nodes, forest, _, _ = _forest(batches)
    roots = nodes[[forest.root(i) for i in range(len(nodes))]] if len(nodes) else nodes
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["node", "component"])


def spanning(edges: DataFrame, n_edges: int) -> DataFrame:
    """Edges (``a, b``) that connect the same nodes; a forest while one task can hold them all."""
    parts = max(1, -(-n_edges // FOREST_EDGES))
    return edges.select("a", "b").repartition(parts, "a").mapInArrow(_span, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b`` long): the smallest node reachable."""
    state = materialise(edges.select("a", "b").filter("a <> b"), "edges")
    n = state.count()
    if n > FOREST_EDGES:
        state = materialise(spanning(state, n), "forest")
        n = state.count()
    if n <= FOREST_EDGES:
        return state.repartition(1, "a").mapInArrow(_label, "node long, component long")
    state = materialise(state.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        # u > v everywhere. Large star: larger neighbours of a node go to its smallest one.
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small star: smaller neighbours, and the node, go to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        state = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
    # Stars now: every node but the smallest has one edge.
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
