"""The same operators on inputs that reach their rarer branches: unmatched and NULL keys, missing JSON paths and
broken JSON, special pages, tied maxima, days without rows. Each input is a projection of a whole driver table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import keyed_average
from ..operators.extremes import argmax_single, keep_max_semi
from ..operators.joins import membership_flag, null_safe_on
from ..operators.ordering import sort_with_position
from ..operators.quantiles import exact_median
from ..operators.weather import max_range_per_day
from ..session import materialize, table
from ..sources.files import range_source
from .registry import register

R = 4


@register("spend_unmatched", f"""
WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 10 <> 3 THEN c_mktsegment END AS segment FROM customer WHERE c_custkey >= 100),
people AS (
  SELECT c_custkey, c_nationkey, CASE WHEN segment IS NOT NULL THEN CAST(left(segment, 3) IN (
    SELECT left(segment, 3) FROM c WHERE c_nationkey < 3 AND segment <> 'MACHINERY') AS INTEGER) END AS known_prefix FROM c)
SELECT CAST(known_prefix AS VARCHAR) AS known_prefix, CAST(CAST(c_nationkey = 1 AND known_prefix = 0 AS INTEGER) AS VARCHAR) AS other_prefix, count(o_orderkey) AS counts,
       round(avg(o_totalprice), {R}) AS average, round(median(o_totalprice), {R}) AS median
FROM orders LEFT JOIN people ON c_custkey = o_custkey GROUP BY ALL
""")
def spend_unmatched(spark, sf_dir):
    """Orders of customers that the dimension lacks (keys below 100) and of customers without a segment: outer join,
    ``IN`` as a three-valued flag, NULL groups."""
    customers = table(spark, sf_dir, "customer").where("c_custkey >= 100").select(
        "c_custkey", "c_nationkey", F.expr("CASE WHEN c_custkey % 10 <> 3 THEN c_mktsegment END").alias("segment"))
    members = customers.where("c_nationkey < 3 AND segment <> 'MACHINERY'").select(F.substring("segment", 1, 3).alias("prefix"))
    flagged = membership_flag(customers, F.substring("segment", 1, 3), members, "prefix", "known_prefix")
    people = materialize(flagged.select("c_custkey", F.col("known_prefix").cast("string").alias("known_prefix"), (
        (F.col("c_nationkey") == 1) & (F.col("known_prefix") == 0)).cast("int").cast("string").alias("other_prefix")))
    o, keys = table(spark, sf_dir, "orders"), ["known_prefix", "other_prefix"]
    joined = materialize(o.join(people, o.o_custkey == people.c_custkey, "left").select(*keys, "o_orderkey", "o_totalprice"))
    stats = joined.groupBy(*keys).agg(F.count("o_orderkey").alias("counts"), F.round(F.avg("o_totalprice"), R).alias("average"))
    med = exact_median(joined, keys, "o_totalprice", "median")
    return stats.join(med, null_safe_on(stats, med, keys), "left").select(
        *[stats[k] for k in keys], "counts", "average", F.round(med.median, R).alias("median"))


TIED_PAGES_SQL = """
p AS (SELECT strftime(ts, '%Y%m%d-%H') AS hour, floor(value / 25) AS views,
             CASE WHEN user_id = 7 THEN 'Main_Page' WHEN user_id % 11 = 0 THEN 'Special:' || user_id ELSE CAST(user_id AS VARCHAR) END AS title
      FROM events WHERE event_type IN ('click', 'view')),
wiki AS (SELECT hour, title, CAST(views AS BIGINT) AS views FROM p WHERE NOT starts_with(title, 'Special:') AND title <> 'Main_Page')"""


def _tied_pages(spark, sf_dir):
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
    title = (F.when(F.col("user_id") == 7, F.lit("Main_Page"))
             .when(F.col("user_id") % 11 == 0, F.concat(F.lit("Special:"), F.col("user_id").cast("string")))
             .otherwise(F.col("user_id").cast("string")))
    pages = ev.select(F.date_format("ts", "yyyyMMdd-HH").alias("hour"), title.alias("title"),
                      F.floor(F.col("value") / 25).cast("long").alias("views"))
    return pages.where(~F.col("title").startswith("Special:") & (F.col("title") != "Main_Page"))


@register("popular_ties", f"""
WITH {TIED_PAGES_SQL}
SELECT hour, title, views, count(*) AS times, row_number() OVER (ORDER BY hour, title) AS rn
FROM wiki w WHERE views = (SELECT max(views) FROM wiki w2 WHERE w2.hour = w.hour) GROUP BY hour, title, views
""")
def popular_ties(spark, sf_dir):
    """All pages tied for an hour's most views (views are coarse, so most hours have several), with their places in
    the sorted result; special pages are left out."""
    best = keep_max_semi(_tied_pages(spark, sf_dir), ["hour"], "views").groupBy("hour", "title", "views").agg(
        F.count(F.lit(1)).alias("times"))
    return sort_with_position(best, ["hour", "title"], unique=True)


@register("argmax_ties", f"""
WITH {TIED_PAGES_SQL}
SELECT hour, max(views) AS views, max(title) FILTER (views = m) AS title
FROM (SELECT *, max(views) OVER (PARTITION BY hour) AS m FROM wiki) GROUP BY hour
""")
def argmax_ties(spark, sf_dir):
    """One page an hour: of those tied for the most views the last by name."""
    return argmax_single(_tied_pages(spark, sf_dir), ["hour"], "views", "title")


@register("json_path_missing", """
WITH p AS (SELECT CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'no json' WHEN event_id % 5 = 0 THEN '{"other": 1}'
                       WHEN event_id % 3 = 0 THEN '{"k": null}' ELSE props END AS props FROM events)
SELECT json_extract_string(props, '$.k') AS k, count(*) AS n
FROM (SELECT CASE WHEN json_valid(props) THEN props END AS props FROM p)
WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1
""")
def json_path_missing(spark, sf_dir):
    """A path that is missing, null, or in a text that is no JSON counts in no group."""
    props = F.expr("""CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'no json' WHEN event_id % 5 = 0 THEN '{"other": 1}'
                           WHEN event_id % 3 = 0 THEN '{"k": null}' ELSE props END""")
    k = F.get_json_object(props, "$.k")
    return table(spark, sf_dir, "events").select(k.alias("k")).where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@register("temp_range_ties", """
WITH w AS (
  SELECT user_id, strftime(ts, '%Y%m%d') AS date, event_type, floor(value / 50) * 50 AS value FROM events
  WHERE event_id % 5 <> 0 AND event_type IN ('view', 'click')),
d AS (SELECT date, CAST(user_id AS VARCHAR) AS station, max(value) FILTER (event_type = 'view') AS hi, min(value) FILTER (event_type = 'click') AS lo
      FROM w GROUP BY ALL),
r AS (SELECT date, station, round((hi - lo) / 10, 1) AS range FROM d WHERE hi IS NOT NULL AND lo IS NOT NULL)
SELECT date, station, range, row_number() OVER (ORDER BY date, station) AS rn
FROM r WHERE range = (SELECT max(range) FROM r q WHERE q.date = r.date)
""")
def temp_range_ties(spark, sf_dir):
    """Stations tied for the day's largest range (readings are coarse), in order with their places; readings repeat
    within a day, and stations with only one of the two elements drop out."""
    obs = _coarse_observations(spark, sf_dir)
    return sort_with_position(max_range_per_day(obs), ["date", "station"], unique=True)


def _coarse_observations(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("station"), F.date_format("ts", "yyyyMMdd").alias("date"),
        F.when(F.col("event_type") == "view", "TMAX").when(F.col("event_type") == "click", "TMIN").otherwise("PRCP").alias("observation"),
        (F.floor(F.col("value") / 50) * 50).cast("int").alias("value"), F.when(F.col("event_id") % 5 == 0, F.lit("X")).alias("qflag"))


@register("keyed_average_nulls", f"""
SELECT k AS event_type, round(avg(v), {R}) AS average
FROM (SELECT CASE WHEN event_id % 4 <> 0 THEN event_type END AS k,
             CASE WHEN event_id % 6 <> 0 AND event_type <> 'error' THEN value END AS v FROM events) GROUP BY k
""")
def keyed_average_nulls(spark, sf_dir):
    """A NULL key is a group of its own; NULL scores don't count; a group of NULL scores only has a NULL mean."""
    rows = table(spark, sf_dir, "events").select(
        F.expr("CASE WHEN event_id % 4 <> 0 THEN event_type END").alias("event_type"),
        F.expr("CASE WHEN event_id % 6 <> 0 AND event_type <> 'error' THEN value END").alias("score"))
    return keyed_average(rows, "event_type", "score").select("event_type", F.round("average", R).alias("average"))


@register("range_days", """
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last FROM orders),
s AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
      FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT strftime(s.day, '%Y-%m-%d') AS day, coalesce(n, 0) AS n_orders, coalesce(total, 0) AS total
FROM s LEFT JOIN o ON s.day = o.day
""")
def range_days(spark, sf_dir):
    """A range source as a calendar: every day between the first and the last order, also those without an urgent one."""
    o = table(spark, sf_dir, "orders")
    first, last = o.agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    days = range_source(spark, (last - first).days + 1, 4).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))
    daily = o.where(F.col("o_orderpriority") == "1-URGENT").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    return days.join(daily, "day", "left").select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("n", F.lit(0)).alias("n_orders"),
                                                  F.coalesce(F.col("total").cast("double"), F.lit(0.0)).alias("total"))


@register("global_reduce", f"""
SELECT count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total, round(avg(l_quantity), {R}) AS mean_quantity,
       max(l_discount) AS max_discount FROM lineitem
""")
def global_reduce(spark, sf_dir):
    """All rows reduced to one: partial results of each task, one final row; the sum is exact (decimal)."""
    return table(spark, sf_dir, "lineitem").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total"),
        F.round(F.avg("l_quantity"), R).alias("mean_quantity"), F.max("l_discount").alias("max_discount"))
