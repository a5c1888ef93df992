"""Global sort with a dense position column, computed without a single-task window.

``row_number() OVER (ORDER BY ...)`` with no partition runs in one task.
Here the data are range-partitioned by ``orderBy``, materialised once, and
each row's position is its partition's offset (from a table with one row
per partition, broadcast because its size is the partition count) plus
its index inside the partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def sort_with_position(df: DataFrame, order: list[Column | str], position_col: str = "rn", unique: bool = False) -> DataFrame:
    """``df`` in ``order`` with positions from 1. ``unique``: no two rows are equal on ``order``."""
    if unique:
        ordered = materialize(df.orderBy(*order))
    else:
        # a row id as the last key: rows equal on ``order`` (in any number) are
        # still cut into balanced ranges; their relative order is arbitrary anyway.
        # Ids follow a local sort, so a recomputed task reproduces them exactly.
        ordered = materialize(df.sortWithinPartitions(*order).withColumn("_tie", F.monotonically_increasing_id())
                              .orderBy(*order, "_tie").drop("_tie"))
    tagged = ordered.select(
        "*",
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    # one row per non-empty partition; ordering that tiny table in one task is fine
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, subset=["_off"])
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = tagged.join(F.broadcast(offsets), "_pid").withColumn(
        position_col, (F.col("_off") + local + 1).cast("long"))
    # rows keep their range partition and in-partition order: no further sort
    return out.drop("_pid", "_mid", "_off")
