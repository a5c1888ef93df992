"""Access-log pipeline: text → parse → ids, per-host traffic, correlation, regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.logs import host_request_bytes, parse_log_lines
from ..operators.aggregates import linear_regression, pearson_from_sums, six_sums
from ..session import scratch_path, table
from ..sources.files import read_text
from ..sources.sinks import write_text
from .fixtures import LOGS_SQL, log_lines
from .registry import register

R = 4


def staged_logs(spark, sf_dir):
    """Render the events as gzip access-log files, scan them back and parse.

    Gzip files cannot be split, so the scan is spread by a round-robin
    repartition before the regex work.
    """
    path = write_text(log_lines(spark, sf_dir), scratch_path(spark, "logs"), compression="gzip")
    lines = read_text(spark, path, min_partitions=spark.sparkContext.defaultParallelism)
    return parse_log_lines(lines)


@register("log_parse", f"""
WITH {LOGS_SQL}
SELECT host, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, path, bytes FROM logs
""")
def log_parse(spark, sf_dir):
    logs = staged_logs(spark, sf_dir)
    return logs.select("host", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
                       "path", "bytes")


def with_ids(df):
    """Random UUID per row. ``uuid()`` is non-deterministic, so callers write
    the result once and read it back instead of recomputing it."""
    return df.withColumn("id", F.expr("uuid()"))


@register("log_ids", f"""
WITH {LOGS_SQL}
SELECT count(*) AS n, count(*) AS n_ids, 36 AS min_len, 36 AS max_len, CAST(sum(bytes) AS BIGINT) AS total_bytes FROM logs
""")
def log_ids(spark, sf_dir):
    """Attach ids, store once, and verify: one distinct 36-character id per row."""
    stored = scratch_path(spark, "log_ids")
    with_ids(staged_logs(spark, sf_dir)).write.mode("overwrite").parquet(stored)
    back = spark.read.parquet(stored)
    return back.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"),
                    F.min(F.length("id")).alias("min_len"), F.max(F.length("id")).alias("max_len"),
                    F.sum("bytes").alias("total_bytes"))


@register("host_traffic", f"""
WITH {LOGS_SQL}
SELECT host, count(*) AS x, CAST(sum(bytes) AS BIGINT) AS y FROM logs GROUP BY host
""")
def host_traffic(spark, sf_dir):
    return host_request_bytes(staged_logs(spark, sf_dir))


SIX_SQL = f"""
WITH {LOGS_SQL},
xy AS (SELECT host, count(*) AS x, sum(bytes) AS y FROM logs GROUP BY host),
s AS (SELECT count(*) AS n,
       CAST(sum(CAST(x AS HUGEINT)) AS DOUBLE) AS sum_x, CAST(sum(CAST(y AS HUGEINT)) AS DOUBLE) AS sum_y,
       CAST(sum(CAST(x AS HUGEINT) * y) AS DOUBLE) AS sum_xy,
       CAST(sum(CAST(x AS HUGEINT) * x) AS DOUBLE) AS sum_x2,
       CAST(sum(CAST(y AS HUGEINT) * y) AS DOUBLE) AS sum_y2 FROM xy)"""


@register("six_sums", f"{SIX_SQL}\nSELECT * FROM s")
def six_sums_q(spark, sf_dir):
    return six_sums(host_request_bytes(staged_logs(spark, sf_dir)))


@register("log_correlation", f"""{SIX_SQL}
SELECT round(r, 6) AS r, round(r * r, 6) AS r2 FROM (
  SELECT CASE WHEN n * sum_x2 - sum_x * sum_x > 0 AND n * sum_y2 - sum_y * sum_y > 0
         THEN (n * sum_xy - sum_x * sum_y) / (sqrt(n * sum_x2 - sum_x * sum_x) * sqrt(n * sum_y2 - sum_y * sum_y))
         END AS r FROM s)
""")
def log_correlation(spark, sf_dir):
    """Pearson r of (requests, bytes) per host, from the six sums in one job."""
    sums = six_sums(host_request_bytes(staged_logs(spark, sf_dir)))
    r = pearson_from_sums(sums)
    return r.select(F.round("r", 6).alias("r"), F.round("r2", 6).alias("r2"))


@register("total_bytes", f"""
WITH {LOGS_SQL}
SELECT CAST(sum(bytes) AS BIGINT) AS total_bytes, count(*) AS n FROM logs
""")
def total_bytes(spark, sf_dir):
    logs = staged_logs(spark, sf_dir)
    return logs.agg(F.sum("bytes").alias("total_bytes"), F.count(F.lit(1)).alias("n"))


@register("linear_regression", """
SELECT regr_count(value, user_id) AS n, round(regr_slope(value, user_id), 6) AS beta,
       round(regr_intercept(value, user_id), 6) AS alpha
FROM events
""")
def linear_regression_q(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    fit = linear_regression(ev, "user_id", "value")
    return fit.select(F.col("n").cast("long").alias("n"), F.round("beta", 6).alias("beta"),
                      F.round("alpha", 6).alias("alpha"))
