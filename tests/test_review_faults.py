"""Rows that earlier lost or changed data."""

import json

from pyspark.sql import functions as F

from tessera.functions.logs import parse_log_lines
from tessera.jobs import job_keyed_mean_lines, job_split_by_sign
from tessera.operators.joins import relative_score
from tessera.operators.upsert import upsert_by_key
from tessera.plans.warehouse import register_prefix_view
from tessera.sources.sinks import json_array_line


def test_json_array_keeps_line_separators(spark):
    values = ["a\u2028b", "a\u0085b", "a\u2029", "plain", None]
    df = spark.createDataFrame([(v, 1) for v in values], "v string, n int")
    got = [json.loads(r[0]) for r in df.select(json_array_line(F.col("v"), F.col("n"))).collect()]
    assert got == [[v, 1] for v in values]


def test_log_path_with_control_character(spark):
    line = 'host\u0001x - - [01/Aug/1995:00:00:01 -0400] "GET /a\u000177 HTTP/1.0" 200 10'
    row = parse_log_lines(spark.createDataFrame([(line,)], "value string")).first()
    assert (row.host, row.path, row.bytes) == ("host\u0001x", "/a\u000177", 10)


def test_change_wins_at_equal_version(spark):
    old = spark.createDataFrame([(1, "z", 1), (2, "q", 5)], "k int, v string, version int")
    new = spark.createDataFrame([(1, "a", 1), (2, "r", 4)], "k int, v string, version int")
    got = {r.k: r.v for r in upsert_by_key(old, new, ["k"], "version").collect()}
    assert got == {1: "a", 2: "q"}


def test_missing_score_has_no_sign_and_quoted_score_counts(spark, tmp_path):
    lines = ['{"subreddit":"e","score":"5","author":"a"}', '{"subreddit":"e","author":"b"}',
             '{"subreddit":"e","score":-7,"author":"c"}', '{"subreddit":"e","score":0,"author":"d"}']
    (tmp_path / "in.json").write_text("\n".join(lines))
    job_split_by_sign(spark, str(tmp_path / "in.json"), str(tmp_path / "out"))
    got = {(r.author, r.sign) for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert got == {("a", "positive"), ("c", "negative"), ("d", "negative")}


def test_corrupt_lines_are_counted(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"subreddit":"e","score":"5"}\n{"subreddit":\n{"subreddit":"e","score":7}')
    job_keyed_mean_lines(spark, str(tmp_path / "in.json"), str(tmp_path / "out"))
    row = spark.read.csv(str(tmp_path / "out-corrupt"), header=True, inferSchema=True).first()
    assert (row.corrupt_lines, row.lines) == (1, 3)


def test_view_reads_its_tables_when_queried(spark, tmp_path):
    schema = "c_custkey long, c_nationkey int, c_mktsegment string"
    path = str(tmp_path / "customer.parquet")
    spark.createDataFrame([(1, 1, "AAA1"), (2, 9, "BBB1"), (3, 9, None)], schema).write.parquet(path)
    flags = lambda: {r.custid: r.known_prefix for r in spark.table("late_flags").collect()}
    register_prefix_view(spark, str(tmp_path), "late_flags")
    assert flags() == {1: 1, 2: 0, 3: None}
    spark.createDataFrame([(4, 2, "BBB2")], schema).write.mode("append").parquet(path)
    assert flags() == {1: 1, 2: 1, 3: None, 4: 1}


def test_hot_key_of_relative_score_is_split(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"),
            F.lit(2.0).alias("s"), F.sha2(F.col("id").cast("string"), 256).alias("a"))
        out = relative_score(rows, "k", "s", "a")
        assert len(out.collect()) == 200_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
