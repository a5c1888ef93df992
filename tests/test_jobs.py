"""Command-line jobs end to end on files written from the driver tables."""

import os

from pyspark.sql import functions as F

from tessera import jobs
from tessera.plans.fixtures import comments, log_lines, weather_observations
from tessera.plans.graph import succession_edges
from tessera.session import table
from tessera.sources.files import adjacency_lines
from tessera.streaming.commits import read_current

from .conftest import SF_SMALL


def test_wordcount_job(spark, tmp_path):
    src = str(tmp_path / "docs")
    table(spark, SF_SMALL, "documents").select("text").write.text(src)
    jobs.main(["word_count", src, str(tmp_path / "out")])
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    words = [ln.rsplit(" ", 1)[0] for ln in lines]
    assert words == sorted(words) and len(words) == len(set(words)) > 1000


def test_reddit_jobs(spark, tmp_path):
    src = str(tmp_path / "comments")
    comments(spark, SF_SMALL).select(F.lower("subreddit").alias("subreddit"),
                                     F.col("score").cast("long").alias("score"), "author").write.json(src)
    jobs.main(["keyed_mean", src, str(tmp_path / "avg")])
    avg = spark.read.csv(str(tmp_path / "avg"), schema="subreddit string, average double")
    assert avg.count() == 5
    jobs.main(["relative_score", src, str(tmp_path / "rel"), "true"])
    assert spark.read.text(str(tmp_path / "rel")).count() > 0
    jobs.main(["split_by_sign", src, str(tmp_path / "etl")])
    parts = sorted(d for d in os.listdir(tmp_path / "etl") if d.startswith("sign="))
    assert parts == ["sign=negative", "sign=positive"]
    back = spark.read.json(str(tmp_path / "etl"))
    assert back.where(~F.col("subreddit").contains("e")).count() == 0
    assert back.where((F.col("sign") == "positive") != (F.col("score") > 0)).count() == 0


def test_weather_and_logs_jobs(spark, tmp_path):
    obs = str(tmp_path / "obs")
    weather_observations(spark, SF_SMALL).write.csv(obs)
    jobs.main(["temp_range", obs, str(tmp_path / "range")])
    assert spark.read.csv(str(tmp_path / "range")).count() > 0
    logs = str(tmp_path / "logs")
    log_lines(spark, SF_SMALL).write.option("compression", "gzip").text(logs)
    jobs.main(["log_correlation", logs, str(tmp_path / "r")])
    r = spark.read.option("header", True).csv(str(tmp_path / "r")).first()
    assert -1.0 <= float(r["r"]) <= 1.0


def test_shortest_path_job(spark, tmp_path):
    src = str(tmp_path / "graph")
    adjacency_lines(succession_edges(spark, SF_SMALL)).write.text(src)
    first = table(spark, SF_SMALL, "orders").orderBy("o_orderkey").first()
    start = str(first["o_custkey"])
    jobs.main(["shortest_path", src, str(tmp_path / "out"), start, start])
    assert [r.value for r in spark.read.text(str(tmp_path / "out" / "path")).collect()] == [start]


def test_weather_ml_jobs(spark, tmp_path):
    from tessera.plans.ml import daily_weather
    src = str(tmp_path / "tmax")
    daily_weather(spark, SF_SMALL).select("station", "date", *[F.col(c).cast("float") for c in
                                          ("latitude", "longitude", "elevation", "tmax")]).write.csv(src)
    model = str(tmp_path / "model")
    jobs.main(["tmax_train", src, model])
    m = spark.read.option("header", True).csv(model + "-metrics").first()
    assert float(m["rmse"]) >= 0
    jobs.main(["tmax_next_day", src, str(tmp_path / "tomorrow"), model])
    out = spark.read.option("header", True).csv(str(tmp_path / "tomorrow"))
    assert out.count() == daily_weather(spark, SF_SMALL).select("station").distinct().count()
    jobs.main(["tmax_test", src, str(tmp_path / "test"), model])
    assert spark.read.option("header", True).csv(str(tmp_path / "test")).count() == 1


def test_colour_classify_job(spark, tmp_path):
    from tessera.plans.colour import part_colours
    src = str(tmp_path / "colours")
    part_colours(spark, SF_SMALL).select("R", "G", "B", F.col("p_type").alias("word"),
                                         F.lit("1").alias("confidence")).write.csv(src)
    jobs.main(["colour_classify", src, str(tmp_path / "f1")])
    rows = spark.read.option("header", True).csv(str(tmp_path / "f1")).collect()
    assert sorted(r["features"] for r in rows) == ["lab", "rgb"]


def test_stream_regression_job(spark, tmp_path):
    src = tmp_path / "points"
    src.mkdir()
    (src / "p.txt").write_text("0 1\n1 3\n2 5\n")
    out = str(tmp_path / "fit")
    jobs.main(["stream_regression", str(src), out, "text", "30", str(tmp_path / "ck")])
    r = read_current(spark, out).first()
    assert r["n"] == 3 and abs(r["beta"] - 2.0) < 1e-9 and abs(r["alpha"] - 1.0) < 1e-9


def test_stream_job_ends_at_its_timeout(spark, tmp_path):
    """A live source never runs dry; the job still ends, and leaves a whole result."""
    import time
    out = str(tmp_path / "fit")
    start = time.time()
    jobs.main(["stream_regression", "-", out, "rate", "15", str(tmp_path / "ck")])
    assert 15 <= time.time() - start < 60
    assert read_current(spark, out).columns == ["n", "beta", "alpha"]


def test_file_format_jobs(spark, tmp_path):
    import __spark_entry__ as entry
    from tessera.plans.io import _pagecount_files
    q = entry.queries()
    # page counts per hour, hour from each file's name
    pages = _pagecount_files(spark, SF_SMALL)
    jobs.main(["popular_per_hour", pages, str(tmp_path / "pop")])
    assert spark.read.json(str(tmp_path / "pop")).count() == q["path_to_hour"](spark, SF_SMALL).count()
    # weather ETL to gzip JSON
    obs = str(tmp_path / "obs")
    weather_observations(spark, SF_SMALL).write.csv(obs)
    jobs.main(["weather_etl", obs, str(tmp_path / "etl"), "1"])
    assert spark.read.json(str(tmp_path / "etl")).count() == q["weather_etl"](spark, SF_SMALL).count()
    # keyed mean from raw JSON lines (scores as numbers or quoted numbers)
    lines = str(tmp_path / "lines")
    spark.createDataFrame([('{"subreddit": "a", "score": "4"}',), ('{"subreddit": "a", "score": 2}',),
                           ('{"subreddit": "b", "score": 1}',), ("not json",)], "value string").write.text(lines)
    jobs.main(["keyed_mean_lines", lines, str(tmp_path / "km")])
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "km")).collect()) == ['["a", 3.0]', '["b", 1.0]']
    # log rows appended twice to a table by format name
    logs = str(tmp_path / "logs")
    log_lines(spark, SF_SMALL).write.text(logs)
    table_path = str(tmp_path / "logtable")
    jobs.main(["log_table_append", logs, table_path])
    jobs.main(["log_table_append", logs, table_path])
    t = spark.read.parquet(table_path)
    parsed = q["log_parse"](spark, SF_SMALL).count()
    assert t.count() == 2 * parsed                       # both batches, every row
    assert t.select("id").distinct().count() == t.count()   # one fresh id per row
