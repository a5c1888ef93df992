"""Command-line jobs over files in the original input formats.

    python -m tessera.jobs <job> <input> <output> [args...]

Each job reads its input with a declared schema, runs library operators and
writes its result; nothing is collected to the driver.
"""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.json import corrupt_count, decode_json_lines
from .functions.logs import host_request_bytes, parse_log_lines
from .functions.paths import path_to_hour
from .functions.text import format_pair, score_sign
from .operators.aggregates import keyed_average, word_count
from .operators.extremes import keep_max_semi
from .operators.graph import bfs_levels, path_from_levels
from .operators.joins import relative_score
from .operators.weather import max_range_per_day, weather_etl
from .sources.files import graph_edges, read_csv, read_delimited_with_file, read_json, read_text
from .sources.sinks import json_array_line, write_csv, write_json, write_split, write_table, write_text

# Input schemas of the original jobs.
COMMENT_SCHEMA = (
    "archived boolean, author string, author_flair_css_class string, author_flair_text string, "
    "body string, controversiality long, created_utc string, distinguished string, downs long, "
    "edited string, gilded long, id string, link_id string, name string, parent_id string, "
    "retrieved_on long, score long, score_hidden boolean, subreddit string, subreddit_id string, ups long"
)
OBSERVATION_SCHEMA = ("station string, date string, observation string, value int, "
                      "mflag string, qflag string, sflag string, obstime string")
PAGECOUNT_SCHEMA = "language string, title string, views long, size long"
TMAX_SCHEMA = ("station string, date date, latitude float, longitude float, "
               "elevation float, tmax float")


def job_word_count(spark, inputs, output):
    """``word count`` lines, sorted by word."""
    counts = word_count(read_text(spark, inputs), "value").orderBy("word")
    write_text(format_pair(F.col("word"), F.col("count")), output, df=counts)


def job_keyed_mean(spark, inputs, output):
    """Mean score per subreddit from JSON comments (CSV out)."""
    comments = read_json(spark, inputs, COMMENT_SCHEMA)
    write_csv(keyed_average(comments, "subreddit", "score"), output)


def job_keyed_mean_lines(spark, inputs, output):
    """Same from raw lines; the score may be a number or a quoted number. The count of
    lines that are no JSON objects goes to ``<output>-corrupt``."""
    dec = decode_json_lines(read_text(spark, inputs), "subreddit string, score string")
    rows = dec.where(~F.col("_corrupt")).select("subreddit", F.col("score").try_cast("double").alias("score"))
    avg = keyed_average(rows, "subreddit", "score")
    write_text(json_array_line(F.col("subreddit"), F.col("average")), output, df=avg)
    write_csv(corrupt_count(dec), output + "-corrupt", header=True)


def scored_comments(spark, inputs):
    """Comments whose score may be a number or a quoted number."""
    loose = COMMENT_SCHEMA.replace(" score long", " score string")
    return read_json(spark, inputs, loose).withColumn("score", F.col("score").try_cast("long"))


def job_split_by_sign(spark, inputs, output):
    """Comments of subreddits containing 'e', split into positive/ and negative/ by score;
    a comment without a score is in neither."""
    c = scored_comments(spark, inputs).where(F.col("subreddit").contains("e"))
    rows = c.select("subreddit", "score", "author", score_sign(F.col("score")).alias("sign")).where("sign IS NOT NULL")
    write_split(rows, output, "sign")


def job_relative_score(spark, inputs, output, broadcast="false"):
    """Each comment's score relative to its subreddit's average, best first."""
    c = scored_comments(spark, inputs)
    rel = relative_score(c, "subreddit", "score", "author", broadcast_averages=broadcast == "true")
    ordered = rel.orderBy(F.desc("relative_score"), "author")
    write_text(json_array_line(F.col("relative_score"), F.col("author")), output, df=ordered)


def job_weather_etl(spark, inputs, output, prefix="CA"):
    obs = read_csv(spark, inputs, OBSERVATION_SCHEMA)
    write_json(weather_etl(obs, station_prefix=prefix), output, compression="gzip")


def job_temp_range(spark, inputs, output):
    obs = read_csv(spark, inputs, OBSERVATION_SCHEMA)
    write_csv(max_range_per_day(obs), output)


def job_popular_per_hour(spark, inputs, output):
    """Most viewed English pages per hour (hour from each file name), ties kept."""
    pages = read_delimited_with_file(spark, inputs, PAGECOUNT_SCHEMA, sep=" ")
    wiki = pages.where((F.col("language") == "en") & ~F.col("title").startswith("Special:")
                       & (F.col("title") != "Main_Page")).select(
        path_to_hour(F.col("filename")).alias("hour"), "title", "views")
    best = keep_max_semi(wiki, ["hour"], "views").orderBy("hour", "title")
    best.coalesce(1).write.mode("overwrite").json(output)


def job_log_correlation(spark, inputs, output):
    """r and r² of requests vs bytes per host."""
    from .operators.aggregates import pearson_from_sums, six_sums
    xy = host_request_bytes(parse_log_lines(read_text(spark, inputs, spark.sparkContext.defaultParallelism)))
    write_csv(pearson_from_sums(six_sums(xy)), output, header=True)


def job_log_table_append(spark, inputs, output, fmt="parquet"):
    """Parsed log rows with a random id appended to a keyed table (by format name)."""
    logs = parse_log_lines(read_text(spark, inputs, spark.sparkContext.defaultParallelism))
    write_table(logs.withColumn("id", F.expr("uuid()")), fmt, mode="append", path=output)


def job_shortest_path(spark, inputs, output, start, end, max_depth="6"):
    """Levels written per iteration under output/iter-i, the path under output/path."""
    edges = graph_edges(read_text(spark, inputs))
    levels = bfs_levels(edges, start, int(max_depth), end=end)
    for i, lv in enumerate(levels):
        lv.write.mode("overwrite").json(f"{output}/iter-{i}")
    path = path_from_levels(levels, end).orderBy("step")
    path.select(F.col("node").alias("value")).coalesce(1).write.mode("overwrite").text(f"{output}/path")


def job_tmax_test(spark, inputs, output, model_path):
    """Score a CSV of daily tmax with a saved pipeline; write r2 / rmse."""
    from .ml.features import regression_metrics
    data = read_csv(spark, inputs, TMAX_SCHEMA)
    pred = PipelineModel.load(model_path).transform(data)
    write_csv(regression_metrics(pred, "tmax"), output, header=True)


def job_tmax_train(spark, inputs, model_out, yesterday="true", regressor="gbt"):
    """Fit the tmax pipeline (prior-day SQL stage, assembler, regressor) on a
    stable 75% split, write validation r2 / rmse next to the saved model."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from .ml.features import day_of_year_stage, hashed_split, prior_day_stage, regression_metrics
    from .plans.ml import WITH_YESTERDAY, WITHOUT_YESTERDAY, _regressor
    data = read_csv(spark, inputs, TMAX_SCHEMA)
    train, valid = hashed_split(data, ["station", "date"])
    with_y = yesterday == "true"
    stages = [prior_day_stage() if with_y else day_of_year_stage(),
              VectorAssembler(inputCols=WITH_YESTERDAY if with_y else WITHOUT_YESTERDAY, outputCol="features"),
              _regressor(regressor)]
    model = Pipeline(stages=stages).fit(train)
    model.write().overwrite().save(model_out)
    write_csv(regression_metrics(model.transform(valid), "tmax"), model_out + "-metrics", header=True)


def job_tmax_next_day(spark, inputs, output, model_path):
    """Tomorrow's tmax per station from each station's latest row in ``inputs``
    (CSV, same layout as training data), scored with a saved pipeline."""
    model = PipelineModel.load(model_path)
    today = read_csv(spark, inputs, TMAX_SCHEMA)
    last = today.groupBy("station").agg(F.max("date").alias("date"))
    latest = today.join(last, ["station", "date"], "left_semi")
    tomorrow = latest.select("station", F.date_add("date", 1).alias("date"), "latitude", "longitude",
                             "elevation", F.lit(0.0).cast("float").alias("tmax"))
    scored = model.transform(latest.unionByName(tomorrow))
    out = scored.join(tomorrow.select("station", "date"), ["station", "date"], "left_semi")
    write_csv(out.select("station", "date", "prediction"), output, header=True)


def job_colour_classify(spark, inputs, output, seed="42"):
    """Colour words from RGB and from LAB with a multilayer perceptron; weighted F1 per model."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import VectorAssembler
    from .ml.features import RgbToLab, hashed_split
    from .ml.labels import LabelDictionary, confusion, weighted_f1
    data = read_csv(spark, inputs, "R int, G int, B int, word string, confidence string")
    labels = LabelDictionary.of(data, "word")  # of all rows: a label may be missing in the training split
    n_labels = labels.table.count()
    train, valid = hashed_split(labels.encode(data, "word").where("label IS NOT NULL"), data.columns, seed=int(seed))
    rows = []
    for name, pre, cols in (("rgb", [], ["R", "G", "B"]), ("lab", [RgbToLab()], ["labL", "labA", "labB"])):
        mlp = MultilayerPerceptronClassifier(layers=[3, 30, n_labels], seed=int(seed))
        model = Pipeline(stages=[*pre, VectorAssembler(inputCols=cols, outputCol="features"), mlp]).fit(train)
        rows.append((name, float(weighted_f1(confusion(model.transform(valid))).first()["f1"])))
    write_csv(spark.createDataFrame(rows, "features string, f1 double"), output, header=True)


def job_stream_regression(spark, source, output, fmt="kafka", timeout="600", checkpoint=None):
    """Running slope/intercept of "x y" messages for ``timeout`` seconds. ``source`` is a topic (kafka;
    servers from ``spark.tessera.kafka.servers``), a directory (text), or nothing for a source without one (``-``).
    The result at ``output`` is read with ``tessera.streaming.commits.read_current``."""
    from .streaming.regression import read_stream, start_regression
    if fmt == "kafka":
        servers = spark.conf.get("spark.tessera.kafka.servers")
        messages = read_stream(spark, "kafka", **{"kafka.bootstrap.servers": servers, "subscribe": source})
    else:
        messages = read_stream(spark, fmt, None if source == "-" else source)
    if output == "-":
        q = start_regression(spark, messages, checkpoint=checkpoint, sink="console",
                             available_now=False, truncate="false")
    else:   # the running (beta, alpha) table is replaced at ``output`` every micro-batch
        q = start_regression(spark, messages, checkpoint=checkpoint, sink="table",
                             available_now=False, table_path=output)
    q.awaitTermination(int(timeout))   # the only wait; a stopped micro-batch leaves the last committed result
    q.stop()


JOBS = {name[4:]: fn for name, fn in dict(globals()).items() if name.startswith("job_")}


def main(argv=None):
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("inputs")
    p.add_argument("output")
    p.add_argument("extra", nargs="*")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"tessera-{a.job}").getOrCreate()
    JOBS[a.job](spark, a.inputs, a.output, *a.extra)


if __name__ == "__main__":
    main()
