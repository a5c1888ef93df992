"""Exact median per group without gathering a group into one task.

Spark's ``median`` / ``percentile`` keep a map of every distinct value of a
group in one aggregation buffer, so a group holding a third of the rows
lands in one task's memory. Here the values are range-partitioned by
(group, value, row id) — a hot group, even a hot value, spreads over many
partitions — and each group's middle positions are found from
per-(partition, group) counts, a table whose size is partitions + groups,
not rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import checked_broadcast


def exact_median(df: DataFrame, group_cols: list[str], value: str, out: str = "median") -> DataFrame:
    vals = df.select(*group_cols, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    # a row id breaks ties, so even one value repeated across a third of the
    # rows is cut into many ranges (equal values are interchangeable here).
    # Ids are assigned after a local sort, so a recomputed task (lost
    # executor) gives every row the same id and range again.
    vals = vals.sortWithinPartitions(*group_cols, "_v").withColumn("_tie", F.monotonically_increasing_id())
    ordered = materialize(vals.repartitionByRange(*group_cols, "_v", "_tie")
                          .sortWithinPartitions(*group_cols, "_v", "_tie"))
    tagged = ordered.select(*group_cols, "_v", F.spark_partition_id().alias("_pid"),
                            F.monotonically_increasing_id().alias("_mid"))
    # rows of one group are contiguous inside a partition (sorted), so a
    # piece is (partition, group) with its first row id and size
    pieces = tagged.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    by_group = Window.partitionBy(*group_cols)
    pieces = pieces.select(
        *group_cols, "_pid", "_n", "_first",
        F.coalesce(F.sum("_n").over(by_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_n").over(by_group).alias("_total"),
    )
    lo = F.floor((F.col("_total") + 1) / 2)
    hi = F.ceil((F.col("_total") + 1) / 2)
    targets = pieces.select(
        "_pid", "_first", "_off", "_n", *group_cols,
        F.array_distinct(F.array(lo, hi)).alias("_pos"),
    ).select("_pid", "_first", "_off", "_n", F.explode("_pos").alias("_p"))
    # keep the target positions that fall inside this piece; their row id
    targets = targets.where((F.col("_p") > F.col("_off")) & (F.col("_p") <= F.col("_off") + F.col("_n"))) \
        .select("_pid", (F.col("_first") + F.col("_p") - F.col("_off") - 1).alias("_mid"))
    # at most two target rows per group: broadcast after a size check, so
    # picking them never shuffles the full value table
    targets, _ = checked_broadcast(targets)
    picked = tagged.join(targets, ["_pid", "_mid"], "left_semi")
    return picked.groupBy(*group_cols).agg(F.avg("_v").alias(out))
