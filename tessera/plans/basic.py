"""Word count, keyed averages, ETL filters and global aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WORD_SEPARATORS, score_sign
from ..operators import aggregates as agg
from ..operators.ordering import sort_with_position
from ..operators.weather import weather_etl
from ..session import scratch_path, table
from ..sources.files import range_source, read_json
from ..sources.sinks import write_split
from .fixtures import WEATHER_SQL, comments, weather_observations
from .registry import register

R = 4  # decimals kept for floating results in both engines


@register("wordcount", f"""
WITH t AS (SELECT unnest(regexp_split_to_array(text, '{WORD_SEPARATORS}')) AS tok FROM documents),
w AS (SELECT lower(tok) AS word FROM t)
SELECT word, count(*) AS count, row_number() OVER (ORDER BY word) AS rn
FROM w WHERE word <> '' GROUP BY word
""")
def wordcount(spark, sf_dir):
    counts = agg.word_count(table(spark, sf_dir, "documents"), "text")
    return sort_with_position(counts, ["word"], unique=True)


@register("keyed_average", f"""
SELECT event_type, round(avg(value), {R}) AS average, count(*) AS n FROM events GROUP BY event_type
""")
def keyed_average(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.groupBy("event_type").agg(F.round(F.avg("value"), R).alias("average"),
                                        F.count(F.lit(1)).alias("n"))


ETL_SPLIT_SQL = """
SELECT subreddit, score, author, CASE WHEN score > 0 THEN 'positive' ELSE 'negative' END AS sign
FROM (SELECT c_mktsegment AS subreddit, c_acctbal - 4500 AS score, c_name AS author FROM customer)
WHERE contains(subreddit, 'E') AND score IS NOT NULL
"""


@register("etl_split", ETL_SPLIT_SQL)
def etl_split(spark, sf_dir):
    """Comments whose subreddit contains 'E', written once into positive/ and negative/; a row without a score is in neither."""
    rows = comments(spark, sf_dir).where(F.col("subreddit").contains("E")).select(
        "subreddit", "score", "author", score_sign(F.col("score")).alias("sign")).where("sign IS NOT NULL")
    path = write_split(rows, scratch_path(spark, "etl_split"), "sign")
    back = read_json(spark, path, "subreddit string, score double, author string, sign string")
    return back.select("subreddit", "score", "author", "sign")


@register("weather_etl", f"""
WITH {WEATHER_SQL}
SELECT station, date, value / 10 AS tmax FROM weather
WHERE qflag IS NULL AND starts_with(station, '1') AND observation = 'TMAX'
""")
def weather_etl_q(spark, sf_dir):
    return weather_etl(weather_observations(spark, sf_dir), station_prefix="1")


@register("distinct_values", "SELECT DISTINCT event_type FROM events")
def distinct_values(spark, sf_dir):
    return agg.distinct_values(table(spark, sf_dir, "events"), "event_type")


POINT_KEYS = [0, 7, 4242, 9999, 123456, 599999]


@register("point_lookup", f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey IN ({', '.join(map(str, POINT_KEYS))})
""")
def point_lookup(spark, sf_dir):
    """Key lookup: the IN list reaches the Parquet scan as a pushed filter."""
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderkey").isin(POINT_KEYS)).select("o_orderkey", "o_custkey", "o_totalprice")


@register("range_global_mean", """
SELECT count(*) AS n, CAST(count(*) - 1 AS DOUBLE) / 2 AS mean_id,
       CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS sum_id
FROM lineitem
""")
def range_global_mean(spark, sf_dir):
    """Integer range source as long as lineitem, spread like its scan; global reduce."""
    li = table(spark, sf_dir, "lineitem")
    n = li.count()
    parts = max(li.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    ids = range_source(spark, n, parts)
    return ids.agg(F.count(F.lit(1)).alias("n"), F.avg("id").alias("mean_id"), F.sum("id").alias("sum_id"))
