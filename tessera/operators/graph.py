"""Bounded breadth-first search over an edge table, and path reconstruction.

Each level is one distributed step: frontier ⋈ edges → drop already
visited nodes (left-anti) → one parent per new node (the smallest source,
a partial+final ``min``). Every level is checkpointed to the shared folder,
so lineage stays one level deep and a lost executor recomputes one level.
The driver only sees "is the new level empty / does it hold the target".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .joins import fits_broadcast, measure


def _prepared_edges(edges: DataFrame, node: str, neighbour: str) -> DataFrame:
    """Distinct (src, dst) edges, checkpointed once so the input is parsed once.

    The edge table is deliberately not hash-partitioned by source: a node
    holding a third of all edges would pin them to one partition, and AQE
    can only split a skewed join side that is shuffled. Per level, AQE
    broadcasts a small frontier (no edge shuffle at all) or splits hot
    partitions of a large one.
    """
    key_type = edges.schema[node].dataType
    e = edges.select(F.col(node).alias("_src"), F.col(neighbour).cast(key_type).alias("_dst")).distinct()
    return materialize(e)


def bfs_levels(edges: DataFrame, start, max_depth: int = 6, end=None,
               node: str = "node", neighbour: str = "neighbour") -> list[DataFrame]:
    """Levels 0..k as DataFrames ``(node, source, distance)``.

    Stops after ``max_depth`` expansions, when a level is empty, or when
    the level holding ``end`` is found. ``source`` of the start is NULL.
    """
    return _levels(_prepared_edges(edges, node, neighbour), edges.schema[node].dataType, start, max_depth, end)


def _levels(e: DataFrame, key_type: T.DataType, start, max_depth: int, end=None) -> list[DataFrame]:
    """``bfs_levels`` over prepared edges."""
    spark: SparkSession = e.sparkSession
    schema = T.StructType([T.StructField("node", key_type), T.StructField("source", key_type),
                           T.StructField("distance", T.IntegerType())])
    level0 = spark.createDataFrame([(start, None, 0)], schema)
    levels = [level0]
    if end is not None and start == end:
        return levels
    frontier, frontier_size = level0, (1, 0)
    visited_rows, visited_bytes = 1, 0
    for d in range(1, max_depth + 1):
        # a checkpointed side has no size estimate, so without an explicit
        # choice every level would shuffle the whole edge table before AQE
        # could switch to a broadcast; measured sides are broadcast instead
        src = frontier.select(F.col("node").alias("_src"))
        if fits_broadcast(*frontier_size):
            src = F.broadcast(src)
        visited = reduce(DataFrame.unionByName, [lv.select("node") for lv in levels])
        step = src.join(e, "_src").select(F.col("_dst").alias("node"), F.col("_src").alias("source"))
        smallest = F.min("source").alias("source")
        if fits_broadcast(visited_rows, visited_bytes):   # visited nodes go before the shuffle
            new = step.join(F.broadcast(visited), "node", "left_anti").groupBy("node").agg(smallest)
        else:   # one row a node is left before the join, which meets the aggregate's own partitioning
            new = step.groupBy("node").agg(smallest).join(visited, "node", "left_anti")
        new = materialize(new.withColumn("distance", F.lit(d)))
        frontier_size = measure(new)
        if frontier_size[0] == 0:
            break
        levels.append(new)
        visited_rows += frontier_size[0]
        visited_bytes += frontier_size[1]
        if end is not None and not new.where(F.col("node") == F.lit(end)).isEmpty():
            break
        frontier = new
    return levels


def bfs(edges: DataFrame, start, max_depth: int = 6, **kw) -> DataFrame:
    """All reached nodes with their distance and parent, as one DataFrame."""
    return reduce(DataFrame.unionByName, bfs_levels(edges, start, max_depth, **kw))


def path_from_levels(levels: list[DataFrame], end) -> DataFrame:
    """``(step, node)`` from the start (step 0) to ``end``; empty if ``end`` was not reached.

    The target's level is found once; then each step joins the one-row
    current node to the previous level only (its parent is there) and
    checkpoints that row, so every level table is scanned once and the
    plan stays linear in the depth.
    """
    spark: SparkSession = levels[0].sparkSession
    key_type = levels[0].schema["node"].dataType
    hit = reduce(DataFrame.unionByName, [lv.select("node", "distance") for lv in levels]) \
        .where(F.col("node") == F.lit(end)).select("distance").first()
    if hit is None:
        return spark.createDataFrame([], T.StructType([T.StructField("step", T.IntegerType()),
                                                       T.StructField("node", key_type)]))
    d = hit[0]
    cur = levels[d].where(F.col("node") == F.lit(end))
    parts = [cur.select(F.col("distance").alias("step"), "node")]
    for k in range(d - 1, -1, -1):
        # one row: broadcast it, the level table is streamed in place
        cur = materialize(levels[k].join(F.broadcast(cur.select(F.col("source").alias("node"))), "node"))
        parts.append(cur.select(F.col("distance").alias("step"), "node"))
    return reduce(DataFrame.unionByName, parts)


def shortest_path(edges: DataFrame, start, end, max_depth: int = 6, **kw) -> DataFrame:
    return path_from_levels(bfs_levels(edges, start, max_depth, end=end, **kw), end)


def walk_levels(edges: DataFrame, start, max_depth: int = 6,
                node: str = "node", neighbour: str = "neighbour") -> DataFrame:
    """The union-then-distinct formulation's result: per node within ``max_depth``, every parent at the
    previous distance, not just one (rows ``node, source, distance``; the start has a NULL source).

    A walk of length d that reaches a node at distance d only visits nodes at
    the distances 0..d-1 in turn, so revisits never add a row. The distances
    come from a breadth-first search, which expands each node once; one join
    of the edges with the distances of both ends then finds all parents.
    """
    e = _prepared_edges(edges, node, neighbour)
    levels = _levels(e, edges.schema[node].dataType, start, max_depth)
    # written once: a plain side of both joins, which AQE can split at a hot node
    distance = materialize(reduce(DataFrame.unionByName, levels).select("node", "distance"))
    if fits_broadcast(*measure(distance)):
        distance = F.broadcast(distance)
    source = distance.select(F.col("node").alias("_src"), F.col("distance").alias("_before"))
    target = distance.select(F.col("node").alias("_dst"), "distance")
    parents = e.join(source, "_src").join(target, "_dst").where(F.col("distance") == F.col("_before") + 1)
    return levels[0].unionByName(parents.select(F.col("_dst").alias("node"), F.col("_src").alias("source"), "distance"))
