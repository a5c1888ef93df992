"""Hard negatives against brute force on whole integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.hard_negatives import Best, Group, hard_negatives, spanning_tree

SCHEMA = "vec_id long, embedding array<float>, label int, _id long, _a string, score int, rank int"


def rows(seed, n, dim=6, size=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(3)]
    out = []
    for i in range(n):
        label = 0 if i % 3 == 0 else rng.randrange(3)  # one label holds more than a third
        out.append((i, [size * (c + rng.gauss(0, 0.7)) for c in centres[label]], label, i, "x", 1, 2))
    return out


def odd():
    base = rows(1, 330)
    nan, inf = float("nan"), float("inf")
    extra = [(None, [1.0] * 6, 1), (100, None, 1), (200, [1.0] * 5 + [nan], 1), (201, [inf] + [1.0] * 5, 1), (202, [None] + [1.0] * 5, 1),
             (300, [1.0] * 6, None), (203, [], 1), (204, [1e30] * 6, 1), (400, [1.0, 2.0, -1.0], 2), (401, [1.0, 1.5, -1.0], 2),
             (402, [1.0, 1.0, 0.0], 0), (500, [0.0] * 6, 1), (600, [1.0] * 7, 1)]
    base += [(i, v, lab, None, None, None, None) for i, v, lab in extra]
    base += [(i + 1000, base[i][1], base[i][2], 1, "t", 1, 1) for i in range(40)]  # ties
    base += [base[7], base[100], (100, [0.5] * 6, 2, 0, "", 0, 0)]                 # repeated rows and ids
    return base


def as_float32(v):
    return [None if x is None else float(np.float32(x)) for x in v]


def brute(data, is_anchor, moved, k_pos=5, k_neg=10):
    use = []
    for i, v, lab, *_ in data:
        if i is None or lab is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * x) for x in as_float32(v)]
        if sum(x * x for x in v) < 1 << 62:
            use.append((i, moved(i, lab), tuple(v)))
    out = []
    for a in set(x for x in use if is_anchor(x[0])):
        score = lambda b: sum(x * y for x, y in zip(a[2], b[2]))
        others = sorted(((-score(b), b[0], b[1]) for b in use if b[0] != a[0] and len(b[2]) == len(a[2])))
        for s, p, _ in [x for x in others if x[2] == a[1]][:k_pos]:
            window = [x for x in others if x[2] != a[1] and 30 * -s <= 100 * -x[0] <= 90 * -s][:k_neg]
            out += [(a[0], p, r + 1, n, -s, -ns) for r, (ns, n, _) in enumerate(window)]
    return sorted(out)


def moved(i, lab):
    return (lab + 1) % 10 if i % 7 == 0 else lab


def run(df, **more):
    label = F.col("label").cast("long")
    return hard_negatives(df, F.col("vec_id") % 100 == 0, F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label), **more)


def test_matches_brute_force(spark):
    data = odd()
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    want = brute(data, lambda i: i % 100 == 0, moved)
    assert len({x[0] for x in want}) >= 4
    assert sorted(map(tuple, run(df).collect())) == want
    # blocks of one anchor, groups and tiles of a few rows: the same rows
    assert sorted(map(tuple, run(df, block_bytes=24, group=2, tile=7).collect())) == want


@pytest.mark.parametrize("size", [1e-3, 300.0, 4e5])  # scores from a few units to beyond 2**53
def test_sizes(spark, size):
    data = rows(3, 150, size=size)
    df = spark.createDataFrame(data, SCHEMA)
    got = hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"), n_positives=3, n_negatives=4, group=4, tile=16)
    assert sorted(map(tuple, got.collect())) == brute(data, lambda i: i % 10 == 0, lambda i, lab: lab, 3, 4)


def test_empty(spark):
    assert run(spark.createDataFrame([], SCHEMA)).count() == 0
    assert run(spark.createDataFrame([(0, [1.0], 1, 0, "", 0, 0)], SCHEMA)).count() == 0


def test_tree_spans_and_bounds_skip():
    rng = np.random.default_rng(0)
    points = np.floor(rng.normal(size=(40, 8)) * 256)
    order, parent, edge = spanning_tree(points)
    place = {int(i): n for n, i in enumerate(order)}
    assert sorted(place) == list(range(40)) and all(place[int(parent[i])] < place[i] for i in order[1:].tolist())
    # Kruskal's total is the least
    pairs = sorted((float(np.linalg.norm(points[i] - points[j])), i, j) for i in range(40) for j in range(i))
    root, total = list(range(40)), 0.0
    find = lambda x: x if root[x] == x else find(root[x])
    for d, i, j in pairs:
        if find(i) != find(j):
            root[find(i)], total = find(j), total + d
    assert math.isclose(total, edge[order[1:]].sum())
    # anchors close to each other: most candidates are never scored for the children
    anchors = np.floor(points[:1] + rng.normal(size=(16, 8)) * 2).astype(np.int64)
    rows_ = np.floor(rng.normal(size=(500, 8)) * 256).astype(np.int64)
    g = Group(np.arange(1000, 1016), np.zeros(16, int), anchors, [[Best(3)] for _ in anchors], True)
    x = rows_.astype(float)
    g.add(np.arange(500), np.zeros(500, int), rows_, x, np.sqrt((x * x).sum(axis=1)))
    assert g.skipped > 0.8 * 15 * 500
    for a, (best,) in zip(anchors, g.searches):
        s = rows_ @ a
        assert best.ids.tolist() == np.lexsort((np.arange(500), -s))[:3].tolist()
