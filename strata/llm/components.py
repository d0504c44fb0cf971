"""Connected components of an edge list by alternating large and small stars.

Each round joins and aggregates edges by key; no component is ever gathered. A round is stored in the shared folder, so
lineage stays short. Rounds grow with the logarithm of the longest path. The steps of a round have one task for so many
edges, at most the cluster's number: a round of few edges is not dealt over hundreds of tasks and files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_parts, store

TASK_EDGES = 10_000


def _store(df: DataFrame, edges: int, name: str) -> DataFrame:
    """Stores a step on so many edges, in as many tasks and files as they need."""
    tasks = max(1, -(-edges // TASK_EDGES))
    return store(df.coalesce(tasks) if tasks < shuffle_parts(df.sparkSession) else df, name)


def _least(edges: DataFrame, node: str, other: str, n: int, name: str) -> DataFrame:
    """Smallest neighbour of each node. Stored, so that the join with it meets two plain inputs: a small one is
    broadcast, and of large ones Spark splits the partition of a node that very many edges have."""
    return _store(edges.groupBy(node).agg(F.min(other).alias("m")), n, name)


def _large(edges: DataFrame, n: int, name: str) -> DataFrame:
    """Every larger neighbour of a node to the smallest of its neighbours and itself.

    Edges go from a larger node u to a smaller v. A node has smaller neighbours only where it is a u, so each edge's
    v is replaced by its own smallest neighbour, if it has one.
    """
    least = _least(edges, "u", "v", n, name).withColumnRenamed("u", "w")
    return edges.join(least, edges["v"] == least["w"], "left").select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small(edges: DataFrame, n: int, name: str) -> DataFrame:
    """Every smaller neighbour of a node, and the node, to the smallest of them."""
    joined = edges.join(_least(edges, "u", "v", n, name), "u")
    return joined.select("u", F.col("m").alias("v")) \
        .union(joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is connected with) of every node of an edge; roots included."""
    e = edges.where(F.col(a) != F.col(b)) \
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e, seen, k = store(e, f"{name}-0"), None, 0
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen, k = mark, k + 1
        e = _store(_large(e, mark[0], f"{name}-{k}-large-least"), mark[0], f"{name}-{k}-large")
        e = _store(_small(e, mark[0], f"{name}-{k}-small-least"), mark[0], f"{name}-{k}-small")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
