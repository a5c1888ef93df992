"""Feature tables, splits, pipeline stages and metrics that stay on Spark."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.colour import rgb_to_lab

# Each row next to its station's value of the day before, whose date is moved on by a day.
PRIOR_DAY_SQL = """
SELECT station, date, latitude, longitude, elevation, tmax, dayofyear(date) AS day_of_year, yesterday_tmax
FROM __THIS__
JOIN (SELECT station, date_add(date, 1) AS date, tmax AS yesterday_tmax FROM __THIS__) AS moved_on
USING (station, date)
"""

DAY_OF_YEAR_SQL = "SELECT *, dayofyear(date) AS day_of_year FROM __THIS__"


def prior_day_stage() -> SQLTransformer:
    return SQLTransformer(statement=PRIOR_DAY_SQL)


def day_of_year_stage() -> SQLTransformer:
    return SQLTransformer(statement=DAY_OF_YEAR_SQL)


def stable_split(df: DataFrame, key: Column, parts: int = 4, holdout: int = 1) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/validation split on an integer key: ``pmod(key, parts) < holdout``
    is validation. Re-running gives the same rows, unlike an unseeded random split."""
    bucket = F.pmod(key, F.lit(parts))
    return df.where(bucket >= holdout), df.where(bucket < holdout)


def hashed_split(df: DataFrame, by: list[str], weights=(0.75, 0.25), seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random-looking split by a hash of the columns ``by``: rows equal in them stay together, and the same rows
    come out whatever the partitioning and order of the input."""
    coin = F.pmod(F.xxhash64(F.lit(seed), *by), F.lit(1 << 30)) / float(1 << 30)
    share = weights[0] / sum(weights)
    return df.where(coin < share), df.where(coin >= share)


class RgbToLab(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage adding LAB columns from R, G, B bytes with JVM expressions."""

    rgbCols = Param(Params._dummy(), "rgbCols", "R, G, B input columns", TypeConverters.toListString)
    labCols = Param(Params._dummy(), "labCols", "L, A, B output columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, rgbCols=None, labCols=None):
        super().__init__()
        self._setDefault(rgbCols=["R", "G", "B"], labCols=["labL", "labA", "labB"])
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        r, g, b = (F.col(c) for c in self.getOrDefault(self.rgbCols))
        lab = rgb_to_lab(r, g, b)
        return dataset.withColumns(dict(zip(self.getOrDefault(self.labCols), lab)))


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """r2 and rmse in one aggregate (same definitions as RegressionEvaluator)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    s = pred.agg(F.count(F.lit(1)).alias("n"), F.sum((y - p) * (y - p)).alias("sse"),
                 F.var_pop(y).alias("var"))
    return s.select("n", (1 - F.col("sse") / (F.col("var") * F.col("n"))).alias("r2"),
                    F.sqrt(F.col("sse") / F.col("n")).alias("rmse"))
