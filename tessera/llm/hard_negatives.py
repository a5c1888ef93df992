"""Hard-negative mining with spanning-tree bounds over the anchors.

Vectors are scaled to integers, so that a score is an exact integer inner
product. Anchors are a stated share of the rows; each is compared with all rows
by a grid of cells: a block of anchors (sized by memory) meets a slot of
candidates, which stream past it in tiles. In a cell the anchors are taken in
small groups, each joined by a minimum spanning tree. The root scores a tile
exactly. A child's scores lie within its parent's plus or minus the length of
the tree's edge times the candidate's norm (Cauchy-Schwarz); only candidates
whose interval overlaps what the child still looks for are scored exactly, the
others hand their interval on to the next child.

Two rounds: first each anchor's best rows of its own label, where the child
looks for scores of its k-th best so far or more; then the rows of other labels
in the score windows which these positives set, where it looks for scores
inside a window that are not below that window's k-th best so far. Cells emit k
rows for each anchor or window, Spark merges them by rank.

Nothing is broadcast, no pair leaves a task unless it is among the best of its
cell. A label with many rows has many slots, so no task holds a whole label.

Defined results: rows with a null id or label, a null or empty vector, or a
null or non-finite component take no part, nor do rows whose squared scaled
norm reaches 2**62 (a score could pass a long). Vectors of different lengths
never meet. Rows with equal ids are candidates of their own, but never of an
anchor with the same id; anchors equal in id, label and vector are one anchor.
Ties go to the smaller id. An anchor without positives, and a positive without
a negative in its window, give no row. An empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stage
from tessera.llm.textcols import ragged

#: Rows of a slot below which a cell isn't split further for the sake of parallel tasks.
LEAST_SLOT = 1 << 14


def scaled_rows(vectors: DataFrame, anchors: Column, label: Column, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``_id, _label, _vec`` (integers), ``_dim`` and ``_asked`` (an anchor) of the rows that take part."""
    finite = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & (F.size(F.col(vec_col)) > 0) & F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("_id"), label.cast("long").alias("_label"),
        F.coalesce(anchors, F.lit(False)).alias("_asked"),
        F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * float(scale))).alias("_long"))
    norm = F.aggregate("_long", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return rows.where(F.col("_label").isNotNull() & (norm < float(1 << 62))).select(
        "_id", "_label", "_asked", F.transform("_long", lambda x: x.cast("int")).alias("_vec"), F.size("_long").alias("_dim"))


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree (Prim): order of visits from point 0, each point's parent, length of that edge."""
    m = len(points)
    square = (points * points).sum(axis=1)
    parent, best, seen = np.zeros(m, int), np.full(m, np.inf), np.zeros(m, bool)
    order, at = [], 0
    for _ in range(m):
        order.append(at)
        seen[at] = True
        far = square + square[at] - 2.0 * (points @ points[at])
        closer = ~seen & (far < best)
        best[closer], parent[closer] = far[closer], at
        at = int(np.argmin(np.where(seen, np.inf, best)))
    step = points - points[parent]
    return np.array(order), parent, np.sqrt((step * step).sum(axis=1))


class Best:
    """The k best (largest score, then smallest id) of those between two scores."""

    __slots__ = ("k", "low", "high", "scores", "ids")

    def __init__(self, k: int, low=None, high=None):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def floor(self):
        """Scores below this one are of no use any more; None: all are."""
        if len(self.scores) < self.k:
            return self.low
        return int(self.scores[-1]) if self.low is None else max(self.low, int(self.scores[-1]))

    def wanted(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a score between ``low`` and ``high`` may be among the best, of these scores and of earlier ones."""
        floor = -np.inf if self.floor is None else self.floor
        sure = low if self.high is None else low[high <= self.high]
        if len(sure) > self.k:  # so many scores reach this one
            floor = max(floor, np.partition(sure, len(sure) - self.k)[len(sure) - self.k])
        return high >= floor if self.high is None else (high >= floor) & (low <= self.high)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        use = np.ones(len(scores), bool) if self.floor is None else scores >= self.floor
        if self.high is not None:
            use &= scores <= self.high
        if use.any():
            s, v = np.concatenate([self.scores, scores[use]]), np.concatenate([self.ids, ids[use]])
            top = np.lexsort((v, -s))[:self.k]
            self.scores, self.ids = s[top], v[top]


class Group:
    """Some anchors under a spanning tree, each with the searches that it makes."""

    def __init__(self, ids, labels, vectors, searches, same_label: bool):
        self.ids, self.labels, self.ints, self.searches, self.same = ids, labels, vectors, searches, same_label
        self.x = vectors.astype(np.float64)
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        self.order, self.parent, self.edge = spanning_tree(self.x)
        self.scored = self.skipped = 0

    def add(self, ids, labels, vectors, x, norm) -> None:
        """Meet one tile of candidates."""
        big = float(self.norm.max(initial=0) * norm.max(initial=0))
        exact = big < 1 << 53  # every partial sum is at most this product, so doubles hold it
        slack = 1.0 + 1e-12 * big
        low = np.empty((len(self.ids), len(ids)))
        high = np.empty_like(low)
        for n, i in enumerate(self.order):
            usable = np.flatnonzero(((labels == self.labels[i]) == self.same) & (ids != self.ids[i]))
            if n:
                reach = self.edge[i] * norm + slack
                low[i], high[i] = low[self.parent[i]] - reach, high[self.parent[i]] + reach
                wanted = np.zeros(len(usable), bool)
                for s in self.searches[i]:
                    wanted |= s.wanted(low[i, usable], high[i, usable])
                usable = at = usable[wanted]
            else:
                at = np.arange(len(ids))
            score = np.rint(x[at] @ self.x[i]).astype(np.int64) if exact else vectors[at].astype(np.int64) @ self.ints[i].astype(np.int64)
            low[i, at] = high[i, at] = score
            self.scored += len(at)
            self.skipped += len(ids) - len(at)
            if not n:
                score = score[usable]
            for s in self.searches[i]:
                s.add(score, ids[usable])


_OUT = "_a long, _search int, anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def _window(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _cells(same_label: bool, k: int, low: int, high: int, group: int, tile: int):
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([(n, pa.int32() if n == "_search" else pa.int64()) for n in
                            ("_a", "_search", "anchor_id", "positive_id", "positive_score", "vec_id", "score")])

        def ints(column, dim):
            return ragged(column)[0].to_numpy(zero_copy_only=False).reshape(-1, dim)

        def open_cell(parts, dim):
            groups = []
            label = np.concatenate([p.column("_label").to_numpy() for p in parts])
            ids = np.concatenate([p.column("_id").to_numpy() for p in parts])
            names = np.concatenate([p.column("_a").to_numpy() for p in parts])
            vectors = np.concatenate([ints(p.column("_vec"), dim) for p in parts])
            positives = [x or [] for p in parts for x in p.column("_positives").to_pylist()]
            by_label = np.lexsort((names, label))  # neighbours in a group are close, so edges are short
            for at in range(0, len(by_label), group):
                some = by_label[at:at + group]
                searches = [[Best(k)] if same_label else [Best(k, *_window(p["score"], low, high)) for p in positives[i]]
                            for i in some]
                groups.append((Group(ids[some], label[some], vectors[some], searches, same_label),
                               names[some], [positives[i] for i in some]))
            return groups

        def emit(groups):
            for g, names, positives in groups:
                rows = [(int(names[i]), j, int(g.ids[i]), *((0, 0) if same_label else (positives[i][j]["vec_id"], positives[i][j]["score"])),
                         int(v), int(s)) for i in range(len(names)) for j, b in enumerate(g.searches[i]) for v, s in zip(b.ids, b.scores)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        at, anchors, groups = None, [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("_dim", "_part", "_block", "_slot", "_kind")], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if hi == lo:
                    continue
                part, (dim, *cell, kind) = batch.slice(lo, hi - lo), key[lo].tolist()
                if (dim, *cell) != at:
                    yield from emit(groups or [])
                    at, anchors, groups = (dim, *cell), [], None
                if kind == 0:
                    anchors.append(part)
                    continue
                if groups is None:
                    groups = open_cell(anchors, dim) if anchors else []
                    anchors = []
                for i in range(0, part.num_rows if groups else 0, tile):
                    some = part.slice(i, tile)
                    vectors = ints(some.column("_vec"), dim)
                    x = vectors.astype(np.float64)
                    norm = np.sqrt((x * x).sum(axis=1))
                    for g, _, _ in groups:
                        g.add(some.column("_id").to_numpy(), some.column("_label").to_numpy(), vectors, x, norm)
        yield from emit(groups or [])
    return run


def _grid(anchors: DataFrame, rows: DataFrame, part: Column, block_bytes: int) -> DataFrame:
    """Anchors and rows dealt to cells (``_dim, _part, _block, _slot``), anchors (``_kind`` 0) first.

    As many blocks as anchors need memory, slots of as many rows as a block has
    anchors; more slots only as long as there are fewer cells than tasks.
    """
    n = partitions(rows.sparkSession)
    keys = ["_dim", "_part"]
    block = F.greatest(F.lit(1), F.floor(F.lit(block_bytes) / (4 * F.col("_dim"))))
    sizes = (rows.select("_dim", part.alias("_part"), F.lit(0).alias("_n_anchors"))
             .unionByName(anchors.select("_dim", part.alias("_part"), F.lit(1).alias("_n_anchors")))
             .groupBy(*keys).agg(F.sum("_n_anchors").alias("_n_anchors"), F.sum(1 - F.col("_n_anchors")).alias("_n_rows"))
             .where("_n_anchors > 0")
             .withColumn("_blocks", F.ceil(F.col("_n_anchors") / block).cast("int"))
             .withColumn("_slots", F.greatest(
                 F.ceil(F.col("_n_rows") / block), F.least(F.ceil(F.col("_n_rows") / LEAST_SLOT), F.ceil(F.lit(n) / F.col("_blocks")))).cast("int"))
             .select(*keys, "_blocks", "_slots"))
    sizes = stage(sizes, "negative-sizes")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = (anchors.withColumn("_part", part).join(sizes, keys)
            .withColumn("_block", F.pmod(F.xxhash64("_a"), F.col("_blocks")).cast("int"))
            .withColumn("_slot", every("_slots")).withColumn("_kind", F.lit(0)))
    right = (rows.withColumn("_part", part).join(sizes, keys)
             .withColumn("_slot", F.pmod(F.xxhash64("_id"), F.col("_slots")).cast("int"))
             .withColumn("_block", every("_blocks")).withColumn("_kind", F.lit(1))
             .withColumn("_a", F.lit(0).cast("long")).withColumn("_positives", F.lit(None).cast(anchors.schema["_positives"].dataType)))
    cols = [*keys, "_block", "_slot", "_kind", "_a", "_id", "_label", "_vec", "_positives"]
    cell = [*keys, "_block", "_slot"]
    return left.select(*cols).unionByName(right.select(*cols)).repartition(n, *cell).sortWithinPartitions(*cell, "_kind")


def _first(found: DataFrame, k: int, *group: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   scale: int = 256, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
                   block_bytes: int = 64 << 20, group: int = 256, tile: int = 2048) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` marks the rows to search for; for each and each of its best
    ``n_positives`` rows of its label, the best ``n_negatives`` rows of other
    labels that score ``low`` to ``high`` percent of the positive's score.
    """
    rows = scaled_rows(vectors, anchors, label, id_col, vec_col, scale)
    asked = rows.where("_asked").drop("_asked").distinct()
    empty = F.array().cast("array<struct<vec_id:long,score:long>>")
    asked = stage(asked.withColumn("_a", F.monotonically_increasing_id()).withColumn("_positives", empty), "negative-anchors")
    found = _grid(asked, rows, F.col("_label"), block_bytes).mapInArrow(_cells(True, n_positives, low, high, group, tile), _OUT)
    pairs = (_first(found, n_positives, "_a").groupBy("_a")
             .agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("_best"))  # n_positives at most
             .select("_a", F.transform("_best", lambda p: F.struct(p["vec_id"].alias("vec_id"), p["score"].alias("score"))).alias("_positives")))
    ready = stage(asked.drop("_positives").join(pairs, "_a"), "negative-windows")
    found = _grid(ready, rows, F.lit(0).cast("long"), block_bytes).mapInArrow(_cells(False, n_negatives, low, high, group, tile), _OUT)
    return _first(found, n_negatives, "_a", "_search").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
