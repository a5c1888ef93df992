"""Edge fixtures (FIXTURES.md §4) and brute-force checks of the custom operators."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tessera.functions.colour import rgb_to_hsv, rgb_to_lab
from tessera.functions.json import corrupt_count, decode_json_lines
from tessera.functions.logs import parse_log_lines
from tessera.functions.paths import path_to_hour
from tessera.functions.text import split_words
from tessera.operators.aggregates import correlation, linear_regression, pearson_from_sums, six_sums, word_count
from tessera.operators.extremes import argmax_single, keep_max_join, keep_max_semi
from tessera.operators.graph import bfs, shortest_path, walk_levels
from tessera.operators.joins import checked_broadcast, membership_flag, relative_score
from tessera.operators.ordering import sort_with_position
from tessera.operators.quantiles import exact_median
from tessera.operators.upsert import upsert_by_key
from tessera.operators.weather import (max_range_per_day, max_range_per_day_pivot,
                                       max_range_per_day_sql, weather_etl)
from tessera.sources.files import adjacency_lines, graph_edges


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---------- text -----------------------------------------------------------

def test_word_split_matches_python_rules(spark):
    import re
    import string
    text = ["Hello, world!  It's  a test of\tsplit--ting", "", "...lead trail...", "ÉCOLE école"]
    sep = re.compile(r"[%s\s]+" % re.escape(string.punctuation))
    expect = {}
    for line in text:
        for w in sep.split(line):
            w = w.lower()
            if w:
                expect[w] = expect.get(w, 0) + 1
    df = spark.createDataFrame([(t,) for t in text], "text string")
    got = {r["word"]: r["count"] for r in word_count(df).collect()}
    assert got == expect


def test_split_keeps_empty_edges(spark):
    df = spark.createDataFrame([(",a,",)], "t string")
    assert df.select(split_words(F.col("t")).alias("p")).first()["p"] == ["", "a", ""]


# ---------- aggregates and ordering ---------------------------------------

def test_sort_with_position_matches_row_number(spark):
    data = [(random.Random(i).randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(data, "k int, v int").repartition(7)
    got = sort_with_position(df, ["k", "v"]).collect()
    assert [r["rn"] for r in got] == list(range(1, 501))
    assert [(r["k"], r["v"]) for r in got] == sorted(data)


def test_exact_median_brute_force_with_hot_group(spark):
    rnd = random.Random(7)
    data = []
    for g in ["a", "b", None]:
        for _ in range(rnd.randint(1, 40)):
            data.append((g, float(rnd.randint(0, 100))))
    data += [("hot", float(rnd.randint(0, 1000))) for _ in range(600)]   # a third of the rows and more
    data += [("even", 1.0), ("even", 2.0), ("even", 10.0), ("even", 20.0), ("nulls", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v").collect()}
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx(statistics.median(vs))


def test_six_sums_and_correlation_agree(spark):
    pts = [(1, 2.0), (2, 4.5), (3, 5.5), (4, 9.0), (5, 9.5)]
    df = spark.createDataFrame(pts, "x long, y double")
    r1 = pearson_from_sums(six_sums(df)).first()["r"]
    r2 = correlation(df).first()["r"]
    xs, ys = zip(*pts)
    assert r1 == pytest.approx(statistics.correlation(xs, ys))
    assert r2 == pytest.approx(r1)


def test_zero_variance_gives_null(spark):
    df = spark.createDataFrame([(3, 1.0), (3, 2.0)], "x long, y double")
    assert pearson_from_sums(six_sums(df)).first()["r"] is None
    assert correlation(df).first()["r"] is None
    assert linear_regression(df).first()["beta"] is None


# ---------- joins and extremes --------------------------------------------

def test_relative_score_drops_nonpositive_groups_both_forms(spark):
    df = spark.createDataFrame(
        [("a", 2.0, "x"), ("a", 4.0, "y"), ("b", -1.0, "z"), ("b", 0.5, "w")],
        "k string, score double, author string")
    for bc in (False, True):
        got = rows(relative_score(df, "k", "score", "author", broadcast_averages=bc), "author", "relative_score")
        assert got == [("x", pytest.approx(2 / 3)), ("y", pytest.approx(4 / 3))]


def test_checked_broadcast_falls_back_beyond_bound(spark):
    df = spark.range(100)
    _, marked = checked_broadcast(df, max_rows=10)
    assert not marked
    side, marked = checked_broadcast(df, max_rows=1000)
    assert marked
    plan = spark.range(1000).join(side, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_keep_max_forms_keep_ties(spark):
    df = spark.createDataFrame([("h1", "p", 5), ("h1", "q", 5), ("h1", "r", 3), ("h2", "s", 1)],
                               "hour string, title string, views long")
    expect = [("h1", "p", 5), ("h1", "q", 5), ("h2", "s", 1)]
    assert rows(keep_max_semi(df, ["hour"], "views"), "hour", "title", "views") == expect
    assert rows(keep_max_semi(df, ["hour"], "views", broadcast=True), "hour", "title", "views") == expect
    assert rows(keep_max_join(df, ["hour"], "views"), "hour", "title", "views") == expect
    # single winner: the larger (views, title) pair
    assert rows(argmax_single(df, ["hour"], "views", "title"), "hour", "title") == [("h1", "q"), ("h2", "s")]


def test_membership_flag_null_rules(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "xyz"), (3, None)], "id int, code string")
    members = spark.createDataFrame([("abc",), (None,)], "m string")
    got = rows(membership_flag(df, F.col("code"), members, "m", "flag"), "id", "flag")
    assert got == [(1, 1), (2, 0), (3, None)]


# ---------- weather -------------------------------------------------------

WEATHER = "station string, date string, observation string, value int, mflag string, qflag string, sflag string, obstime string"


def test_temperature_range_ties_flags_and_unpaired(spark):
    obs = spark.createDataFrame([
        ("A", "20240101", "TMAX", 200, None, None, None, None),
        ("A", "20240101", "TMIN", 100, None, None, None, None),
        ("B", "20240101", "TMAX", 150, None, None, None, None),
        ("B", "20240101", "TMIN", 50, None, None, None, None),     # ties A: range 10.0
        ("C", "20240101", "TMAX", 900, None, "X", None, None),     # flagged: dropped
        ("C", "20240101", "TMIN", 0, None, None, None, None),
        ("D", "20240101", "TMAX", 990, None, None, None, None),    # no TMIN: dropped
        ("E", "20240102", "TMAX", 100, None, None, None, None),
        ("E", "20240102", "TMAX", 120, None, None, None, None),    # duplicate: widest range
        ("E", "20240102", "TMIN", 10, None, None, None, None),
    ], WEATHER)
    expect = [("20240101", "A", 10.0), ("20240101", "B", 10.0), ("20240102", "E", 11.0)]
    assert rows(max_range_per_day(obs), "date", "station", "range") == expect
    assert rows(max_range_per_day_pivot(obs), "date", "station", "range") == expect
    assert rows(max_range_per_day_sql(spark, obs), "date", "station", "range") == expect
    etl = weather_etl(obs, station_prefix="E")
    assert rows(etl, "station", "tmax") == [("E", 10.0), ("E", 12.0)]


# ---------- logs ----------------------------------------------------------

def test_log_parse_edge_lines(spark):
    lines = spark.createDataFrame([
        ('h1 - - [01/Aug/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 1839',),
        ('h2 - - [01/Aug/1995:00:00:07 -0400] "GET /b HTTP/1.0" 304 -',),            # no bytes
        ('h3 - - [02/Aug/1995:13:14:15 +0100] "POST /c HTTP/1.1" 200 3000000000',),   # > 2^31
        ("garbage",),
    ], "value string")
    got = parse_log_lines(lines).orderBy("host").collect()
    assert [r["host"] for r in got] == ["h1", "h3"]
    assert str(got[0]["datetime"]) == "1995-08-01 00:00:01"   # zone offset not applied
    assert got[1]["bytes"] == 3000000000


# ---------- JSON ----------------------------------------------------------

def test_json_scores_as_text(spark):
    lines = spark.createDataFrame([
        ('{"subreddit": "a", "score": "5", "author": "x"}',),
        ('{"subreddit": "a", "score": 7, "author": "y"}',),
        ('{"subreddit": "a", "author": "z"}',),
        ('{"subreddit": "a", "score": ',),
    ], "value string")
    dec = decode_json_lines(lines, "subreddit string, score string, author string")
    kept = dec.where(~F.col("_corrupt")).select(F.col("score").try_cast("double").alias("s"))
    assert sorted(r["s"] for r in kept.collect() if r["s"] is not None) == [5.0, 7.0]
    c = corrupt_count(dec).first()
    assert (c["corrupt_lines"], c["lines"]) == (1, 4)


# ---------- graph ---------------------------------------------------------

GRAPH_LINES = [
    "1: 3 5",
    "2: 4",
    "3: 2 5",
    "4: 3",        # cycle 3 → 2 → 4 → 3
    "5: 6",
    "6: 4",        # 4 reachable at distance 3 via 2 (parent 2) and via 6? (6 is at 2, 4 at 3)
    "7:",          # line without neighbours
    "8: 9",        # unreachable from 1
    "9: 10", "10: 11", "11: 12", "12: 13", "13: 14", "14: 15",
]


def _edges(spark):
    return graph_edges(spark.createDataFrame([(x,) for x in GRAPH_LINES], "value string"))


def test_graph_edges_parse(spark):
    e = rows(_edges(spark), "node", "neighbour")
    assert ("7", "") not in e and ("1", "3") in e and len(e) == 15


def test_bfs_parents_and_distances(spark):
    got = {r["node"]: (r["source"], r["distance"]) for r in bfs(_edges(spark), "1").collect()}
    assert got["1"] == (None, 0)
    assert got["3"] == ("1", 1) and got["5"] == ("1", 1)
    assert got["2"] == ("3", 2) and got["6"] == ("5", 2)
    assert got["4"] == ("2", 3)            # two parents at distance 2: the smaller name wins
    assert "8" not in got


def test_walk_levels_keeps_all_parents(spark):
    got = rows(walk_levels(_edges(spark), "1"), "node", "source", "distance")
    assert ("4", "2", 3) in got and ("4", "6", 3) in got
    assert not any(n == "3" and d > 1 for n, _, d in got)


def test_shortest_path_cases(spark):
    e = _edges(spark)
    assert rows(shortest_path(e, "1", "4"), "step", "node") == [(0, "1"), (1, "3"), (2, "2"), (3, "4")]
    assert rows(shortest_path(e, "1", "1"), "step", "node") == [(0, "1")]
    assert shortest_path(e, "1", "8").count() == 0
    # target at depth 7 is beyond the 6-level cap, reachable with a deeper cap
    assert shortest_path(e, "8", "15").count() == 0
    assert shortest_path(e, "8", "15", max_depth=7).count() == 8


def test_adjacency_round_trip_with_hot_node(spark):
    edges = spark.createDataFrame([(0, i) for i in range(2500)] + [(1, 2)], "node long, neighbour long")
    lines = adjacency_lines(edges, per_line=1000)
    back = graph_edges(lines)
    assert back.count() == 2501
    assert lines.where(F.col("value").startswith("0:")).count() >= 3


# ---------- colour --------------------------------------------------------

def test_hsv_special_colours(spark):
    cols = [(0, 0, 0), (255, 255, 255), (128, 128, 128), (200, 200, 50), (200, 50, 200), (50, 200, 200)]
    df = spark.createDataFrame(cols, "R int, G int, B int")
    h, s, v = rgb_to_hsv(F.col("R"), F.col("G"), F.col("B"))
    got = [(r["h"], r["s"]) for r in df.select(h.alias("h"), s.alias("s")).collect()]
    assert got[0] == (0.0, 0.0) and got[1] == (0.0, 0.0) and got[2] == (0.0, 0.0)
    assert got[3][0] == pytest.approx(1 / 6)
    assert got[4][0] == pytest.approx(5 / 6)
    assert got[5][0] == pytest.approx(1 / 2)


def test_lab_reference_points(spark):
    df = spark.createDataFrame([(255, 255, 255), (0, 0, 0), (255, 0, 0)], "R int, G int, B int")
    l, a, b = rgb_to_lab(F.col("R"), F.col("G"), F.col("B"))
    got = df.select(l.alias("l"), a.alias("a"), b.alias("b")).collect()
    assert got[0]["l"] == pytest.approx(100.0, abs=1e-3) and abs(got[0]["a"]) < 1e-2
    assert got[1]["l"] == pytest.approx(0.0, abs=1e-9)
    assert got[2]["l"] == pytest.approx(53.24, abs=0.01) and got[2]["a"] == pytest.approx(80.09, abs=0.05)


# ---------- upsert, paths -------------------------------------------------

def test_upsert_keeps_latest_version(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, version int")
    changes = spark.createDataFrame([(1, "a2", 2), (1, "a3", 3), (3, "c", 1)], "k long, v string, version int")
    assert rows(upsert_by_key(base, changes, ["k"], "version"), "k", "v") == [(1, "a3"), (2, "b"), (3, "c")]


def test_path_to_hour(spark):
    df = spark.createDataFrame([("hdfs:///x/pagecounts-20160801-120000.gz",),
                                ("/tmp/out/file=pagecounts-20240105-230000/part-0.csv",)], "p string")
    assert [r[0] for r in df.select(path_to_hour(F.col("p"))).collect()] == ["20160801-12", "20240105-23"]


# ---------- streaming restart ---------------------------------------------

def test_stream_state_survives_restart(spark, tmp_path):
    from tessera.streaming.regression import read_stream, start_regression
    src, ckpt = tmp_path / "in", tmp_path / "ckpt"
    src.mkdir()
    (src / "a.txt").write_text("1 2\n2 4\nbad\n3\n")
    q = start_regression(spark, read_stream(spark, "text", str(src)), checkpoint=str(ckpt))
    q.awaitTermination()
    first = spark.table(q.name).first()
    assert first["n"] == 2 and first["beta"] == pytest.approx(2.0)
    # a new file after a restart from the same checkpoint: the sums continue
    (src / "b.txt").write_text("4 9\n")
    q2 = start_regression(spark, read_stream(spark, "text", str(src)), checkpoint=str(ckpt))
    q2.awaitTermination()
    second = spark.table(q2.name).first()
    assert second["n"] == 3
    xs, ys = [1, 2, 4], [2, 4, 9]
    mx, my = sum(xs) / 3, sum(ys) / 3
    beta = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / sum((x - mx) ** 2 for x in xs)
    assert second["beta"] == pytest.approx(beta)


def test_scale_settings():
    from tessera.session import scale_settings
    s = scale_settings(100 << 40, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 819200
    assert int(scale_settings(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16


def test_log_time_ignores_session_zone(spark):
    from tessera.functions.logs import log_wall_clock
    df = spark.createDataFrame([("10/Mar/2024:02:30:00",), ("31/Feb/2024:00:00:00",), ("xx",),
                                ("01/Aug/1995:23:59:59",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")   # 02:30 is a DST gap there
        got = [None if r[0] is None else str(r[0]) for r in df.select(log_wall_clock(F.col("s"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2024-03-10 02:30:00", None, None, "1995-08-01 23:59:59"]


def test_checked_broadcast_byte_bound(spark):
    wide = spark.range(50).select(F.repeat(F.lit("x"), 10000).alias("w"))
    _, marked = checked_broadcast(wide, max_rows=1000, max_bytes=100_000)
    assert not marked
    _, marked = checked_broadcast(wide, max_rows=1000, max_bytes=10_000_000)
    assert marked


def test_write_n_files(spark, tmp_path):
    import os
    from tessera.sources.sinks import write_n_files
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), "id").repartition(5)
    for n in (3, 0):
        out = write_n_files(df, str(tmp_path / f"n{n}"), n, "k" if n else None)
        files = [f for f in os.listdir(out) if f.startswith("part-")]
        assert (len(files) <= 3) if n == 3 else (len(files) == 5)
        assert spark.read.parquet(out).count() == 1000


def test_upsert_leaves_untouched_rows_and_handles_nulls(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, "c", 1), (3, "c-old", 0)],
                                 "k long, v string, version int")
    changes = spark.createDataFrame([(2, "b2", 2), (4, "d", 1)], "k long, v string, version int")
    got = rows(upsert_by_key(base, changes, ["k"], "version"), "k", "v")
    # untouched keys keep every existing row as stored; touched keys collapse to the latest
    assert got == [(1, "a"), (2, "b2"), (3, "c"), (3, "c-old"), (4, "d")]


def test_first_days_average_groups_by_day(spark):
    import datetime as dt
    from tessera.operators.aggregates import first_days_average
    df = spark.createDataFrame([
        (dt.datetime(2021, 8, 1, 9, 0), 10.0), (dt.datetime(2021, 8, 1, 17, 30), 20.0),   # one day
        (dt.datetime(2020, 8, 5, 0, 0), 7.0),                                              # any year
        (dt.datetime(2021, 8, 6, 0, 0), 99.0), (dt.datetime(2021, 7, 1, 0, 0), 99.0),      # outside
    ], "pdate timestamp_ntz, amount double")
    got = rows(first_days_average(df, "pdate", "amount"), "pdate", "avg")
    assert got == [("2020-08-05", 7.0), ("2021-08-01", 15.0)]


def test_stream_to_table_sink(spark, tmp_path):
    from tessera.streaming.commits import read_current
    from tessera.streaming.regression import read_stream, start_regression
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("1 1\n2 3\n3 5\n")
    out = str(tmp_path / "table")
    q = start_regression(spark, read_stream(spark, "text", str(src)), checkpoint=str(tmp_path / "ck"),
                         sink="table", table_path=out)
    q.awaitTermination()
    r = read_current(spark, out).first()
    assert r["n"] == 3 and r["beta"] == pytest.approx(2.0) and r["alpha"] == pytest.approx(-1.0)


def test_upsert_compound_key(spark):
    base = spark.createDataFrame([("h1", "a", 100, 1), ("h1", "b", 200, 1), ("h2", "a", 300, 1)],
                                 "host string, id string, bytes long, version int")
    changes = spark.createDataFrame([("h1", "b", 250, 2), ("h2", "b", 50, 2)],
                                    "host string, id string, bytes long, version int")
    got = rows(upsert_by_key(base, changes, ["host", "id"], "version"), "host", "id", "bytes")
    assert got == [("h1", "a", 100), ("h1", "b", 250), ("h2", "a", 300), ("h2", "b", 50)]


def test_shared_root_rules():
    from tessera.session import scratch_path, shared_root

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Ctx:
        def __init__(self, master, value):
            self.master, self._conf = master, Conf(value)

        def getConf(self):
            return self._conf

    class Session:
        def __init__(self, master, value):
            self.sparkContext = Ctx(master, value)

    with pytest.raises(RuntimeError):                      # a cluster without a shared folder
        shared_root(Session("yarn", None))
    assert shared_root(Session("yarn", "hdfs:///shared/ckpt/")) == "hdfs:///shared/ckpt"
    p = scratch_path(Session("spark://host:7077", "hdfs:///jobs/ckpt"), "part")
    assert p.startswith("hdfs:///jobs/ckpt/scratch/part-")
