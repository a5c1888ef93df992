"""Graph jobs over the customer-succession graph of orders.

Edge: customer of order n → customer of order n+1 (customer keys).
``graph_edges`` round-trips the edges through ``node: n1 n2 ...``
adjacency text, the reference job's input format; the search queries
start from the edge table itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import bfs_levels, path_from_levels, walk_levels
from ..session import scratch_path, table
from ..sources.files import adjacency_lines, graph_edges, read_text
from ..sources.sinks import write_text
from .registry import register

START = 899
MAX_DEPTH = 6

EDGES_SQL = """
e AS (SELECT DISTINCT a.o_custkey AS node, b.o_custkey AS neighbour
      FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1)"""

DIST_SQL = f"""WITH RECURSIVE {EDGES_SQL},
r(node, d) AS (SELECT CAST({START} AS BIGINT), 0 UNION SELECT e.neighbour, r.d + 1 FROM r JOIN e ON e.node = r.node WHERE r.d < {MAX_DEPTH}),
dist AS (SELECT node, min(d) AS distance FROM r GROUP BY node),
par AS (SELECT x.node, CAST(x.distance AS INTEGER) AS distance,
               (SELECT min(p.node) FROM dist p JOIN e ON e.node = p.node
                WHERE e.neighbour = x.node AND p.distance = x.distance - 1) AS source
        FROM dist x)"""


def succession_edges(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    nxt = o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("neighbour"))
    return o.join(nxt, "o_orderkey").select(F.col("o_custkey").alias("node"), "neighbour").distinct()


def staged_edges(spark, sf_dir) -> DataFrame:
    """Edges → adjacency text files → parsed edges (string node names)."""
    path = write_text(adjacency_lines(succession_edges(spark, sf_dir)), scratch_path(spark, "graph"))
    return graph_edges(read_text(spark, path))


@register("graph_edges", f"""WITH {EDGES_SQL}
SELECT CAST(node AS VARCHAR) AS node, CAST(neighbour AS VARCHAR) AS neighbour FROM e""")
def graph_edges_q(spark, sf_dir):
    """Edges parsed from adjacency text (names are strings, as in the text)."""
    return staged_edges(spark, sf_dir)


def _as_names(df):
    """Node ids as text names (the start's parent is NULL), as the reference writes them."""
    return df.select(F.col("node").cast("string").alias("node"), F.col("source").cast("string").alias("source"),
                     "distance")


@register("bfs_levels", f"""{DIST_SQL}
SELECT CAST(node AS VARCHAR) AS node, CAST(source AS VARCHAR) AS source, distance FROM par""")
def bfs_levels_q(spark, sf_dir):
    levels = bfs_levels(succession_edges(spark, sf_dir), START, MAX_DEPTH)
    return _as_names(reduce(DataFrame.unionByName, levels))


@register("union_levels", f"""{DIST_SQL}
SELECT CAST(x.node AS VARCHAR) AS node, CAST(e.node AS VARCHAR) AS source, x.distance
FROM par x JOIN e ON e.neighbour = x.node JOIN par p ON p.node = e.node AND p.distance = x.distance - 1
UNION ALL SELECT '{START}', NULL, 0
""")
def union_levels_q(spark, sf_dir):
    return _as_names(walk_levels(succession_edges(spark, sf_dir), START, MAX_DEPTH))


@register("shortest_path", f"""{DIST_SQL},
target AS (SELECT node FROM par ORDER BY distance DESC, node LIMIT 1),
walk(node, source, step) AS (
  SELECT p.node, p.source, p.distance FROM par p JOIN target t ON p.node = t.node
  UNION ALL
  SELECT p.node, p.source, p.distance FROM walk w JOIN par p ON p.node = w.source)
SELECT CAST(step AS INTEGER) AS step, node FROM walk
""")
def shortest_path_q(spark, sf_dir):
    """Path from the start to the farthest reached node (smallest name among ties)."""
    levels = bfs_levels(succession_edges(spark, sf_dir), START, MAX_DEPTH)
    end = levels[-1].agg(F.min("node")).first()[0]
    return path_from_levels(levels, end)
