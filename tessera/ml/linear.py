"""Gaussian linear model with identity link, by normal equations.

All that a fit needs are the means and (co)variances of features and label:
one aggregate with a single row, merged from the tasks' partial results in a
numerically stable way. The equations, as many as there are features, are then
solved on the driver. The data are read once, whatever the number of features,
and never cached.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """One row: ``n``, means ``m_i`` (the label last) and population covariances ``c_i_j`` (i <= j),
    over the rows without a null in any of the columns."""
    columns = [F.col(c).cast("double") for c in [*features, label]]
    whole = df.select(*[c.alias(f"_{i}") for i, c in enumerate(columns)]).dropna()
    n = range(len(columns))
    return whole.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"_{i}").alias(f"m_{i}") for i in n],
        *[F.covar_pop(f"_{i}", f"_{j}").alias(f"c_{i}_{j}") for i in n for j in n if i <= j])


@dataclass(frozen=True)
class LinearModel:
    """A fitted model. ``r2`` is None if the label doesn't vary."""

    features: list[str]
    label: str
    n: int
    intercept: float
    coefficients: list[float]
    r2: float | None
    rmse: float

    def predict(self) -> Column:
        """The prediction as an expression over the feature columns; null if one of them is."""
        out = F.lit(self.intercept)
        for name, w in zip(self.features, self.coefficients):
            out = out + F.col(name).cast("double") * F.lit(w)
        return out

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        return df.withColumn(prediction, self.predict())


def fit_linear(df: DataFrame, features: list[str], label: str) -> LinearModel:
    """Least squares; of features that depend on each other the solution of least norm. Raises ValueError without rows."""
    row = moments(df, features, label).first()
    k, n = len(features), row["n"]
    if not n:
        raise ValueError("no rows to fit")
    mean = np.array([row[f"m_{i}"] for i in range(k + 1)])
    cov = np.array([[row[f"c_{min(i, j)}_{max(i, j)}"] for j in range(k + 1)] for i in range(k + 1)], dtype=float).reshape(k + 1, k + 1)
    # in units of each feature's spread, so that the rank test doesn't depend on units
    spread = np.sqrt(np.maximum(np.diag(cov)[:k], 0.0))
    spread[spread == 0] = 1.0
    scaled, *_ = np.linalg.lstsq(cov[:k, :k] / np.outer(spread, spread), cov[:k, k] / spread, rcond=1e-12) if k else (np.zeros(0),)
    w = scaled / spread
    explained = float(w @ cov[:k, k])
    rest = max(float(cov[k, k]) - explained, 0.0)
    return LinearModel(list(features), label, n, float(mean[k] - w @ mean[:k]), [float(x) for x in w],
                       explained / float(cov[k, k]) if cov[k, k] > 0 else None, rest ** 0.5)
