"""Weather-observation jobs: ETL filter and the largest daily temperature range.

Input rows follow the observation layout
(station, date, observation, value [tenths], mflag, qflag, sflag, obstime).
Observations are expected once per (station, date, element); if an element
repeats, its extreme value is used (highest TMAX, lowest TMIN), so each
station-day yields one range and no join ever pairs duplicates.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .extremes import keep_max_join, keep_max_semi


def weather_etl(obs: DataFrame, station_prefix: str = "CA") -> DataFrame:
    """Unflagged TMAX readings of stations with a prefix, in degrees."""
    kept = obs.where(F.col("qflag").isNull()
                     & F.col("station").startswith(station_prefix)
                     & (F.col("observation") == "TMAX"))
    return kept.select("station", "date", (F.col("value") / 10).alias("tmax"))


def _clean(obs: DataFrame) -> DataFrame:
    return obs.where(F.col("qflag").isNull() & F.col("observation").isin("TMAX", "TMIN"))


def daily_range_join(obs: DataFrame) -> DataFrame:
    """(station, date, range) from a TMAX table joined to a TMIN table."""
    clean = _clean(obs)
    tmax = (clean.where(F.col("observation") == "TMAX").groupBy("station", "date")
            .agg(F.max("value").alias("tmax")))
    tmin = (clean.where(F.col("observation") == "TMIN").groupBy("station", "date")
            .agg(F.min("value").alias("tmin")))
    both = tmax.join(tmin, ["station", "date"], "inner")
    return both.select("station", "date",
                       F.round(F.col("tmax") / 10 - F.col("tmin") / 10, 1).alias("range"))


def daily_range_pivot(obs: DataFrame) -> DataFrame:
    """Same ranges from one aggregate with conditional columns (no join)."""
    clean = _clean(obs)
    per_day = clean.groupBy("station", "date").agg(
        F.max(F.when(F.col("observation") == "TMAX", F.col("value") / 10)).alias("tmax"),
        F.min(F.when(F.col("observation") == "TMIN", F.col("value") / 10)).alias("tmin"),
    )
    return per_day.where(F.col("tmax").isNotNull() & F.col("tmin").isNotNull()).select(
        "station", "date", F.round(F.col("tmax") - F.col("tmin"), 1).alias("range"))


def max_range_per_day(obs: DataFrame) -> DataFrame:
    """Stations with the day's largest range (ties kept), join + residual filter form."""
    best = keep_max_join(daily_range_join(obs), ["date"], "range")
    return best.select("date", "station", "range").orderBy("date", "station")


def max_range_per_day_sql(spark: SparkSession, obs: DataFrame) -> DataFrame:
    """The SQL-text form built from temp views registered step by step.

    The day's maximum is compared with each row like ``MAX(range) OVER
    (PARTITION BY date)``, but computed as a grouped maximum joined back,
    so one busy day is not a single task. View names carry a per-call
    suffix so concurrent calls on one session do not collide.
    """
    v = f"_{uuid.uuid4().hex[:10]}"
    obs.createOrReplaceTempView(f"weather_obs{v}")
    spark.sql(f"""
        SELECT station, date, observation, value FROM weather_obs{v}
        WHERE qflag IS NULL AND (observation = 'TMAX' OR observation = 'TMIN')
    """).createOrReplaceTempView(f"weather_clean{v}")
    spark.sql(f"""
        SELECT station, date, max(value) / 10 AS tmax FROM weather_clean{v}
        WHERE observation = 'TMAX' GROUP BY station, date
    """).createOrReplaceTempView(f"tmax_days{v}")
    spark.sql(f"""
        SELECT station, date, min(value) / 10 AS tmin FROM weather_clean{v}
        WHERE observation = 'TMIN' GROUP BY station, date
    """).createOrReplaceTempView(f"tmin_days{v}")
    spark.sql(f"""
        SELECT x.date, x.station, ROUND(x.tmax - n.tmin, 1) AS range
        FROM tmax_days{v} x JOIN tmin_days{v} n ON x.date = n.date AND x.station = n.station
    """).createOrReplaceTempView(f"ranges{v}")
    return spark.sql(f"""
        WITH day_max AS (SELECT date, MAX(range) AS maxrange FROM ranges{v} GROUP BY date)
        SELECT r.date, r.station, r.range
        FROM ranges{v} r JOIN day_max m ON r.date = m.date
        WHERE r.range = m.maxrange
        ORDER BY r.date, r.station
    """)


def max_range_per_day_pivot(obs: DataFrame) -> DataFrame:
    best = keep_max_semi(daily_range_pivot(obs), ["date"], "range")
    return best.select("date", "station", "range").orderBy("date", "station")
