"""Connected components of links between keys, as Spark jobs.

Each partition first shrinks its links to a forest with a union-find of its own. Then large-star and small-star steps
(Kiveris et al., Connected Components in MapReduce and Beyond, 2014) alternate until nothing changes. Both steps are a
minimum by key, with partial aggregation, and a join, so a hub with very many links is never gathered in one task.
Lineage is cut with checkpoint() after each round.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _forest(batches):
    parent: dict[bytes, bytes] = {}

    def root(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [(x, root(x)) for x in list(parent)]
    nodes = [(x, r) for x, r in nodes if x != r]
    for i in range(0, len(nodes), 10_000):
        part = nodes[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.binary()), pa.array([r for _, r in part], pa.binary())], names=["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    # the least neighbour takes the place of the node itself, and links to the other lower neighbours
    others = down.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(low.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of links (a, b: binary) that is not its component's least; root is the least."""
    edges = links.where("a != b").select("a", "b").mapInArrow(_forest, "a binary, b binary").checkpoint()
    state = _state(edges)
    while True:
        edges = _small_star(_large_star(edges)).checkpoint()
        now = _state(edges)
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
