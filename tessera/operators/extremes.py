"""Rows holding their group's maximum (ties kept) and single winners per group.

All forms aggregate the maximum per group first (partial + final, so a
hot group costs nothing extra) and bring it back with a join; none of
them uses a window partitioned by the group, which would run a hot
group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_ROWS, checked_broadcast


def group_max(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    return df.groupBy(*group).agg(F.max(value).alias(out))


def keep_max_join(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Inner join on the group, then the residual equality ``value == max``."""
    mx = group_max(df, group, value, "_max")
    return df.join(mx, group, "inner").where(F.col(value) == F.col("_max")).drop("_max")


def keep_max_semi(df: DataFrame, group: list[str], value: str, broadcast: bool = False,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left-semi join on (group, value) against the per-group maxima."""
    mx = group_max(df, group, value, value)
    if broadcast:
        mx, _ = checked_broadcast(mx, max_broadcast_rows)
    return df.join(mx, [*group, value], "left_semi")


def argmax_single(df: DataFrame, group: list[str], value: str, label: str) -> DataFrame:
    """One row per group: the largest (value, label) pair, label breaking ties."""
    best = F.max(F.struct(F.col(value).alias("v"), F.col(label).alias("l"))).alias("_best")
    return df.groupBy(*group).agg(best).select(
        *group, F.col("_best.v").alias(value), F.col("_best.l").alias(label))
