"""Property tests: custom operators against brute force on random, skewed inputs."""

import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.extremes import argmax_single, keep_max_semi
from tessera.operators.ordering import sort_with_position
from tessera.operators.quantiles import exact_median
from tessera.operators.upsert import upsert_by_key

pytestmark = pytest.mark.slow

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

# groups drawn with heavy skew: "hot" is picked far more often than the rest
groups = st.sampled_from(["hot"] * 6 + ["a", "b", "c", None])
values = st.integers(min_value=-5, max_value=5).map(float)   # few distinct values → many ties


@SETTINGS
@given(st.lists(st.tuples(groups, values), min_size=1, max_size=300), st.integers(1, 6))
def test_exact_median_property(spark, data, parts):
    df = spark.createDataFrame(data, "g string, v double").repartition(parts)
    got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v").collect()}
    expect = {}
    for g, v in data:
        expect.setdefault(g, []).append(v)
    assert got == {g: statistics.median(vs) for g, vs in expect.items()}


@SETTINGS
@given(st.lists(st.integers(0, 20), min_size=1, max_size=300), st.integers(1, 6))
def test_positions_are_dense_and_ordered(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(parts)
    got = sort_with_position(df, ["k"]).collect()
    assert [r["rn"] for r in got] == list(range(1, len(keys) + 1))
    assert [r["k"] for r in got] == sorted(keys)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["h1"] * 5 + ["h2", "h3"]), st.sampled_from("pqrs"),
                          st.integers(0, 4)), min_size=1, max_size=200))
def test_group_max_forms(spark, data):
    df = spark.createDataFrame(data, "hour string, title string, views long")
    best = {}
    for h, _, v in data:
        best[h] = max(best.get(h, v), v)
    kept = sorted((h, t, v) for h, t, v in data if v == best[h])
    got = sorted((r.hour, r.title, r.views) for r in keep_max_semi(df, ["hour"], "views").collect())
    assert got == kept
    single = {r.hour: (r.views, r.title) for r in argmax_single(df, ["hour"], "views", "title").collect()}
    assert single == {h: max((v, t) for hh, t, v in data if hh == h) for h in best}


@SETTINGS
@given(st.dictionaries(st.integers(0, 30), st.text("ab", max_size=3), max_size=30),
       st.lists(st.tuples(st.integers(0, 40), st.text("xy", max_size=3), st.integers(2, 5)), max_size=40))
def test_upsert_property(spark, base, changes):
    b = spark.createDataFrame([(k, v, 1) for k, v in base.items()], "k long, v string, version int")
    c = spark.createDataFrame(changes, "k long, v string, version int")
    got = sorted((r.k, r.v) for r in upsert_by_key(b, c, ["k"], "version").collect())
    expect = {k: (1, v) for k, v in base.items()}
    for k, v, ver in changes:
        if k not in expect or (ver, v) > expect[k]:
            expect[k] = (ver, v)
    assert got == sorted((k, v) for k, (_, v) in expect.items())


def _python_bfs(edges, start, max_depth):
    dist, frontier = {start: 0}, {start}
    for d in range(1, max_depth + 1):
        nxt = {b for a, b in edges if a in frontier and b not in dist}
        if not nxt:
            break
        for n in nxt:
            dist[n] = d
        frontier = nxt
    parent = {n: min(a for a, b in edges if b == n and dist.get(a) == dist[n] - 1)
              for n in dist if n != start}
    return dist, parent


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.sets(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=40),
       st.integers(1, 6))
def test_bfs_matches_python(spark, edge_set, depth):
    from tessera.operators.graph import bfs, walk_levels
    edges = sorted(edge_set)
    df = spark.createDataFrame(edges, "node long, neighbour long")
    dist, parent = _python_bfs(edges, 0, depth)
    got = {r["node"]: (r["distance"], r["source"]) for r in bfs(df, 0, depth).collect()}
    assert got == {n: (d, parent.get(n)) for n, d in dist.items()}
    every_parent = {(r["node"], r["source"], r["distance"]) for r in walk_levels(df, 0, depth).collect()}
    expect = {(0, None, 0)} | {(b, a, dist[b]) for a, b in edges
                               if b in dist and b != 0 and dist.get(a) == dist[b] - 1}
    assert every_parent == expect


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1"] * 4 + ["k2", "k3"]), st.integers(-5, 9), st.text("xyz", min_size=1, max_size=3)),
                min_size=1, max_size=120), st.booleans())
def test_relative_score_property(spark, data, broadcast):
    from tessera.operators.joins import relative_score
    df = spark.createDataFrame([(k, float(s), a) for k, s, a in data], "k string, score double, author string")
    sums = {}
    for k, s, _ in data:
        n, t = sums.get(k, (0, 0.0))
        sums[k] = (n + 1, t + s)
    avg = {k: t / n for k, (n, t) in sums.items()}
    expect = sorted((a, s / avg[k]) for k, s, a in data if avg[k] > 0)
    got = sorted((r.author, r.relative_score)
                 for r in relative_score(df, "k", "score", "author", broadcast_averages=broadcast).collect())
    assert [a for a, _ in got] == [a for a, _ in expect]
    assert [v for _, v in got] == pytest.approx([v for _, v in expect])


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from("abcd")), max_size=30),
       st.lists(st.one_of(st.none(), st.sampled_from("abc")), max_size=10))
def test_membership_flag_property(spark, probes, members):
    from pyspark.sql import functions as F
    from tessera.operators.joins import membership_flag
    df = spark.createDataFrame(list(enumerate(probes)), "i int, p string")
    m = spark.createDataFrame([(x,) for x in members], "m string")
    got = sorted((r.i, r.flag) for r in membership_flag(df, F.col("p"), m, "m", "flag").collect())
    present = {x for x in members if x is not None}
    assert got == [(i, None if p is None else int(p in present)) for i, p in enumerate(probes)]
