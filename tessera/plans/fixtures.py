"""Reference-shaped inputs derived from the driver tables (mapping in FIXTURES.md §3).

Each function is a Spark projection of a driver table; the oracle SQL
fragments below state the same derivations for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table


def weather_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → (station, date yyyyMMdd, observation, value tenths, flags)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("station"),
        F.date_format("ts", "yyyyMMdd").alias("date"),
        F.when(F.col("event_type") == "view", "TMAX")
         .when(F.col("event_type") == "click", "TMIN").otherwise("PRCP").alias("observation"),
        F.floor(F.col("value") * 10).cast("int").alias("value"),
        F.lit(None).cast("string").alias("mflag"),
        F.when(F.col("event_id") % 5 == 0, F.lit("X")).alias("qflag"),
        F.lit(None).cast("string").alias("sflag"),
        F.lit(None).cast("string").alias("obstime"),
    )


WEATHER_SQL = """
weather AS (
  SELECT CAST(user_id AS VARCHAR) AS station, strftime(ts, '%Y%m%d') AS date,
         CASE WHEN event_type = 'view' THEN 'TMAX' WHEN event_type = 'click' THEN 'TMIN' ELSE 'PRCP' END AS observation,
         CAST(floor(value * 10) AS INTEGER) AS value,
         CASE WHEN event_id % 5 = 0 THEN 'X' END AS qflag
  FROM events)"""


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → (language, title, views, size, hour): clicks are English pages."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.when(F.col("event_type") == "click", "en").otherwise("fr").alias("language"),
        F.when(F.col("user_id") == 7, F.lit("Main_Page"))
         .otherwise(F.col("user_id").cast("string")).alias("title"),
        F.floor("value").cast("long").alias("views"),
        F.col("event_id").alias("size"),
        F.date_format("ts", "yyyyMMdd-HH").alias("stamp"),
        F.date_format("ts", "yyyyMMdd").alias("hour"),
    )


def english_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English article rows (hour, title, views): no special pages, no main page."""
    pc = page_counts(spark, sf_dir)
    return pc.where((F.col("language") == "en") & ~F.col("title").startswith("Special:")
                    & (F.col("title") != "Main_Page")).select("hour", "title", "views")


PAGES_SQL = """
pagecounts AS (
  SELECT CASE WHEN event_type = 'click' THEN 'en' ELSE 'fr' END AS language,
         CASE WHEN user_id = 7 THEN 'Main_Page' ELSE CAST(user_id AS VARCHAR) END AS title,
         CAST(floor(value) AS BIGINT) AS views, strftime(ts, '%Y%m%d') AS hour
  FROM events),
wiki AS (
  SELECT hour, title, views FROM pagecounts
  WHERE language = 'en' AND NOT starts_with(title, 'Special:') AND title <> 'Main_Page')"""


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → forum comments (subreddit, score, author)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_mktsegment").alias("subreddit"),
        (F.col("c_acctbal") - 4500).alias("score"),
        F.col("c_name").alias("author"),
        F.col("c_nationkey").alias("nation"),
    )


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → access-log fields; error events become lines without a byte count."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("host"), (F.col("user_id") % 50).cast("string")).alias("host"),
        F.col("ts"),
        F.concat(F.lit("/p/"), (F.col("event_id") % 97).cast("string")).alias("path"),
        F.floor(F.col("value") * 100).cast("long").alias("bytes"),
        (F.col("event_type") == "error").alias("broken"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events rendered as access-log text lines (column ``value``)."""
    ev = log_events(spark, sf_dir)
    stamp = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    good = F.format_string('%s - - [%s -0700] "GET %s HTTP/1.0" 200 %d',
                           "host", stamp, "path", "bytes")
    bad = F.format_string('%s - - [%s -0700] "GET %s HTTP/1.0" 404 -', "host", stamp, "path")
    return ev.select(F.when(F.col("broken"), bad).otherwise(good).alias("value"))


LOGS_SQL = """
logs AS (
  SELECT 'host' || CAST(user_id % 50 AS VARCHAR) AS host,
         date_trunc('second', ts) AS datetime,
         '/p/' || CAST(event_id % 97 AS VARCHAR) AS path,
         CAST(floor(value * 100) AS BIGINT) AS bytes
  FROM events WHERE event_type <> 'error')"""
