"""Keyed and global aggregates.

Every keyed aggregate here is algebraic (count / sum / min / max / avg),
so Spark runs a partial aggregate before the shuffle (the map-side
combiner of the MapReduce jobs) and a hot key costs one partial row per
input partition, not one task holding a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import words
from ..session import spread


def word_count(lines: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, count) over lower-cased tokens, empty tokens dropped.

    Only the text column is scanned; a scan with fewer tasks than cores is
    spread first because splitting dominates the cost.
    """
    text = spread(lines.select(text_col))
    tokens = text.select(words(F.col(text_col)).alias("word")).where(F.col("word") != "")
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def keyed_average(df: DataFrame, key: str, value: str, out: str = "average") -> DataFrame:
    """Mean per key (partial (count, sum) state, final divide)."""
    return df.groupBy(key).agg(F.avg(value).alias(out))


def keyed_sums(df: DataFrame, key: str, values: dict[str, str]) -> DataFrame:
    """Several sums per key in one pass: ``{output: input_column}``."""
    return df.groupBy(key).agg(*[F.sum(c).alias(o) for o, c in values.items()])


def keyed_max(df: DataFrame, key: str | list[str], value: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(out))


def keyed_min(df: DataFrame, key: str | list[str], value: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(value).alias(out))


def global_sum(df: DataFrame, value: str, out: str = "total") -> DataFrame:
    return df.agg(F.sum(value).alias(out))


def global_mean(df: DataFrame, value: str, out: str = "mean") -> DataFrame:
    return df.agg(F.avg(value).alias(out), F.count(value).alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def six_sums(xy: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """n, Σx, Σy, Σxy, Σx², Σy² in one aggregate (one job instead of six), as doubles.

    Sums of whole numbers are exact (decimals inside), so the differences that
    a correlation takes of them don't lose digits before they are taken.
    """
    whole = all(isinstance(xy.schema[c].dataType, T.IntegralType) for c in (x, y))
    kind = "decimal(38,0)" if whole else "double"
    xc, yc = F.col(x).cast(kind), F.col(y).cast(kind)
    total = lambda c, name: F.sum(c).cast("double").alias(name)
    return xy.agg(F.count(F.lit(1)).alias("n"), total(xc, "sum_x"), total(yc, "sum_y"), total(xc * yc, "sum_xy"),
                  total(xc * xc, "sum_x2"), total(yc * yc, "sum_y2"))


def pearson_from_sums(sums: DataFrame) -> DataFrame:
    """r and r² from the six sums; NULL when either variance is zero."""
    n, sx, sy = F.col("n"), F.col("sum_x"), F.col("sum_y")
    num = n * F.col("sum_xy") - sx * sy
    vx = n * F.col("sum_x2") - sx * sx
    vy = n * F.col("sum_y2") - sy * sy
    r = F.when((vx > 0) & (vy > 0), num / (F.sqrt(vx) * F.sqrt(vy)))
    return sums.select(r.alias("r")).select("r", (F.col("r") * F.col("r")).alias("r2"))


def correlation(xy: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Pearson r and r² with Spark's single-pass ``corr``.

    Under ANSI mode ``corr`` raises on a zero variance, so that case is
    detected from the two variances in the same aggregate and yields NULL.
    """
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    agg = xy.agg(
        F.var_pop(xc).alias("vx"), F.var_pop(yc).alias("vy"),
        F.covar_pop(xc, yc).alias("cxy"),
    )
    r = F.when((F.col("vx") > 0) & (F.col("vy") > 0),
               F.col("cxy") / (F.sqrt(F.col("vx")) * F.sqrt(F.col("vy"))))
    return agg.select(r.alias("r")).select("r", (F.col("r") * F.col("r")).alias("r2"))


def linear_regression(xy: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Least-squares slope (beta) and intercept (alpha); rows with a NULL side ignored."""
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    return xy.agg(
        F.regr_count(yc, xc).alias("n"),
        F.regr_slope(yc, xc).alias("beta"),
        F.regr_intercept(yc, xc).alias("alpha"),
    )


def first_days_average(df: DataFrame, ts: str, value: str, month: int = 8, before_day: int = 6,
                       out: str = "avg") -> DataFrame:
    """Mean of ``value`` per calendar day for days 1..before_day-1 of ``month``, any year.

    Grouped by the day (the cast expression), not by the raw timestamp, so
    two events on one day form one group. ``pdate`` is the day as text.
    """
    t = F.col(ts)
    kept = df.where((F.date_part(F.lit("mon"), t) == month) & (F.date_part(F.lit("d"), t) < before_day))
    day = F.date_format(F.to_date(t), "yyyy-MM-dd")
    return kept.groupBy(day.alias("pdate")).agg(F.avg(value).alias(out))
