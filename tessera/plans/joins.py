"""Joins and per-group extremes: relative score, temperature range, popular pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.extremes import argmax_single, keep_max_semi
from ..operators.joins import relative_score
from ..operators.ordering import sort_with_position
from ..operators.weather import max_range_per_day, max_range_per_day_pivot, max_range_per_day_sql
from .fixtures import PAGES_SQL, WEATHER_SQL, comments, english_pages, weather_observations
from .registry import register

R = 4

RELATIVE_SQL = f"""
WITH c AS (SELECT c_nationkey AS key, c_acctbal - 4500 AS score, c_name AS author FROM customer),
a AS (SELECT key, avg(score) AS av FROM c GROUP BY key HAVING avg(score) > 0)
SELECT round(score / av, {R}) AS relative_score, author, key,
       row_number() OVER (ORDER BY score / av DESC, author, key) AS rn
FROM c JOIN a USING (key)
"""


def _relative(spark, sf_dir, broadcast):
    c = comments(spark, sf_dir)
    rel = relative_score(c, "nation", "score", "author", broadcast_averages=broadcast)
    ranked = sort_with_position(rel, [F.desc("relative_score"), "author", "key"])
    return ranked.select(F.round("relative_score", R).alias("relative_score"), "author", "key", "rn")


@register("relative_score", RELATIVE_SQL)
def relative_score_q(spark, sf_dir):
    """Shuffle (or AQE-chosen) join of each row to its group's average."""
    return _relative(spark, sf_dir, broadcast=False)


@register("relative_score_broadcast", RELATIVE_SQL)
def relative_score_broadcast_q(spark, sf_dir):
    """Averages broadcast after their row count is checked."""
    return _relative(spark, sf_dir, broadcast=True)


TEMP_RANGE_SQL = f"""
WITH {WEATHER_SQL},
clean AS (SELECT * FROM weather WHERE qflag IS NULL AND observation IN ('TMAX', 'TMIN')),
d AS (SELECT station, date,
             max(CASE WHEN observation = 'TMAX' THEN value END) / 10 AS tmax,
             min(CASE WHEN observation = 'TMIN' THEN value END) / 10 AS tmin
      FROM clean GROUP BY station, date),
r AS (SELECT date, station, round(tmax - tmin, 1) AS range FROM d
      WHERE tmax IS NOT NULL AND tmin IS NOT NULL)
SELECT date, station, range FROM r
WHERE range = (SELECT max(range) FROM r r2 WHERE r2.date = r.date)
"""


@register("temp_range", TEMP_RANGE_SQL)
def temp_range(spark, sf_dir):
    return max_range_per_day(weather_observations(spark, sf_dir))


@register("temp_range_window", TEMP_RANGE_SQL)
def temp_range_window(spark, sf_dir):
    return max_range_per_day_sql(spark, weather_observations(spark, sf_dir))


@register("temp_range_pivot", TEMP_RANGE_SQL)
def temp_range_pivot(spark, sf_dir):
    return max_range_per_day_pivot(weather_observations(spark, sf_dir))


POPULAR_SQL = f"""
WITH {PAGES_SQL}
SELECT hour, title, views FROM wiki w
WHERE views = (SELECT max(views) FROM wiki w2 WHERE w2.hour = w.hour)
"""


@register("popular_per_hour", POPULAR_SQL)
def popular_per_hour(spark, sf_dir):
    """Every page tied for the hour's most views (left-semi join on hour, views)."""
    return keep_max_semi(english_pages(spark, sf_dir), ["hour"], "views").orderBy("hour", "title")


@register("popular_per_hour_broadcast", POPULAR_SQL)
def popular_per_hour_broadcast(spark, sf_dir):
    return keep_max_semi(english_pages(spark, sf_dir), ["hour"], "views", broadcast=True).orderBy("hour", "title")


@register("argmax_single", f"""
WITH {PAGES_SQL},
m AS (SELECT hour, max(views) AS views FROM wiki GROUP BY hour)
SELECT w.hour, w.views, max(w.title) AS title
FROM wiki w JOIN m ON w.hour = m.hour AND w.views = m.views
GROUP BY w.hour, w.views
""")
def argmax_single_q(spark, sf_dir):
    """One page per hour: the largest (views, title) pair."""
    return argmax_single(english_pages(spark, sf_dir), ["hour"], "views", "title")
