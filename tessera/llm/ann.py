"""Exact nearest neighbours of a stated query set by a block matrix join.

Query blocks and candidate slots form a grid: candidates are copied to each
query block, query blocks to each slot, and the cells are the join's keys. A
block holds as many queries as fit into ``block_bytes``, a slot at most as many
candidates, so neither side is copied more often than memory asks for. In
a cell, tiles of candidates meet groups of queries. Both sides are quantised to
int8 (per vector scale); an integer matrix product (int8 values held in float32,
exact below 2**24) gives approximate cosines, and the length of each vector's
quantisation residual bounds their error. A pair survives if its upper bound
reaches the k-th best lower bound of its query; survivors are recomputed in
double precision on the original vectors and merged in heaps of k. The k best
of all cells are merged by a rank that Spark cuts before its shuffle.

No vector pair leaves a task unless it is in a heap of its cell, nothing is
broadcast, and a task holds one query block and one tile of candidates.

Defined results: a vector that is null, empty, zero or holds null or
non-finite components, and one with a null id, takes no part; vectors of
different lengths are never neighbours; ties go to the smaller id; rows with
equal ids are candidates of their own, but never of a query with the same id;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions
from tessera.llm.textcols import ragged


def usable(vec: Column) -> Column:
    """True for vectors with finite components that aren't all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _doubles(column, dim: int) -> np.ndarray:
    flat, _ = ragged(column)
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def quantise(x: np.ndarray):
    """Unit vectors as int8 with scales and the lengths of their residuals."""
    # scaled by the largest component first, so that squares neither overflow nor vanish
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127.0
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1))


def _ordered_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise dot products, added from the first component to the last."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


class Cell:
    """A group of queries with a heap of the k best candidates of each query."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, vectors, k
        self.norm = np.sqrt(_ordered_dot(vectors, vectors))
        self.q, self.scale, self.rest = quantise(vectors)
        # integer products are exact in float32 up to this dimension
        self.kind = np.float32 if vectors.shape[1] * 127 * 127 < 1 << 24 else np.float64
        self.q = self.q.astype(self.kind)
        self.heaps: list[list] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        q, scale, rest = quantise(vectors)
        near = (self.q @ q.astype(self.kind).T).astype(np.float64) * self.scale[:, None] * scale[None, :]
        error = self.rest[:, None] + rest[None, :] + 3 * self.rest[:, None] * rest[None, :] + 1e-9
        near[self.ids[:, None] == ids[None, :]] = -np.inf
        low = near - error
        if low.shape[1] >= self.k:
            kth = np.partition(low, low.shape[1] - self.k, axis=1)[:, low.shape[1] - self.k]
            floor = np.maximum(self.floor, kth)
        else:
            floor = self.floor
        a, b = np.nonzero((near + error >= floor[:, None]) & np.isfinite(near))
        norm = np.sqrt(_ordered_dot(vectors, vectors))
        score = _ordered_dot(self.x[a], vectors[b]) / (self.norm[a] * norm[b])
        for i, s, v in zip(a.tolist(), score.tolist(), ids[b].tolist()):
            heap = self.heaps[i]
            if len(heap) < self.k:
                heapq.heappush(heap, (s, -v))
            else:
                heapq.heappushpop(heap, (s, -v))
        for i in set(a.tolist()):
            if len(self.heaps[i]) == self.k:
                self.floor[i] = max(self.floor[i], self.heaps[i][0][0])

    def best(self):
        for i, heap in zip(self.ids.tolist(), self.heaps):
            for s, v in heap:
                yield i, -v, s


def _tiles(k: int, group: int, tile: int):
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

        def emit(cells):
            rows = [r for cell in cells for r in cell.best()]
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], f.type) for j, f in enumerate(schema)],
                                              schema=schema)

        at, cells, queries = None, None, []
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_dim", "_block", "_slot", "_kind")]
            key = np.stack(cols, axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if hi == lo:
                    continue
                part, (dim, block, slot, kind) = batch.slice(lo, hi - lo), key[lo].tolist()
                if (dim, block, slot) != at:
                    if cells:
                        yield emit(cells)
                    at, cells, queries = (dim, block, slot), None, []
                ids = part.column("_id").to_numpy(zero_copy_only=False).astype(np.int64)
                x = _doubles(part.column("_vec"), dim)
                if kind == 0:
                    queries.append((ids, x))
                    continue
                if cells is None:
                    asked = np.concatenate([a for a, _ in queries]) if queries else np.empty(0, np.int64)
                    vectors = np.concatenate([b for _, b in queries]) if queries else np.empty((0, dim))
                    cells = [Cell(asked[i:i + group], vectors[i:i + group], k) for i in range(0, len(asked), group)]
                    queries = []
                for i in range(0, len(ids), tile):
                    for cell in cells:
                        cell.add(ids[i:i + tile], x[i:i + tile])
        if cells:
            yield emit(cells)
    return run


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
            block_bytes: int = 64 << 20, group: int = 1024, tile: int = 2048) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest cosine for each row where ``queries`` holds."""
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col))).select(
        F.col(id_col).cast("long").alias("_id"), F.col(vec_col).alias("_vec"), F.size(vec_col).alias("_dim"),
        F.coalesce(queries, F.lit(False)).alias("_is_query"))
    asked = rows.where("_is_query").drop("_is_query")
    size = rows.agg(F.count_if("_is_query").alias("asked"), F.count(F.lit(1)).alias("rows"), F.max("_dim").alias("dim")).first()
    block = max(1, block_bytes // (12 * (size["dim"] or 1)))  # a query is held in doubles and, quantised, in floats
    blocks = max(1, -(-size["asked"] // block))
    slots = max(1, -(-size["rows"] // block), -(-partitions(vectors.sparkSession) // blocks))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (asked.withColumn("_block", F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int"))
            .withColumn("_slot", spread(slots)).withColumn("_kind", F.lit(0)))
    right = (rows.drop("_is_query").withColumn("_slot", F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(slots)).cast("int"))
             .withColumn("_block", spread(blocks)).withColumn("_kind", F.lit(1)))
    cells = left.unionByName(right).select("_dim", "_block", "_slot", "_kind", "_id", "_vec")
    key = ["_dim", "_block", "_slot"]
    found = (cells.repartition(blocks * slots, *key).sortWithinPartitions(*key, "_kind")
             .mapInArrow(_tiles(k, group, tile), "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
