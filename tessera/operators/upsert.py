"""Keyed upsert: a newer row for the same primary key replaces the older one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_ROWS, checked_broadcast


def latest_per_key(rows: DataFrame, keys: list[str], version: str, tie: str | None = None) -> DataFrame:
    """Per key, the row with the highest ``version``, then the highest ``tie`` (not returned; a ``max(struct)`` aggregate:
    partial aggregation collapses a key with many versions before the shuffle,
    unlike ranking the rows of a key inside one window partition)."""
    cols = [c for c in rows.columns if c not in (*keys, tie)]
    rank = [F.col(version).alias("_ver"), *([F.col(tie).alias("_tie")] if tie else [])]
    best = F.max(F.struct(*rank, *[F.col(c) for c in cols])).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in cols])


def upsert_by_key(existing: DataFrame, changes: DataFrame, keys: list[str], version: str,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``existing ∪ changes`` keeping, per key, the row with the highest ``version``;
    at equal versions a change replaces the existing row.

    Only keys present in ``changes`` are aggregated. Rows of untouched keys
    pass through a left-anti join against the changed keys, which are
    broadcast after a size check; a small delta on a large table then never
    shuffles the table. Beyond the bound the anti join is a shuffle join.
    """
    changes = changes.select(*existing.columns)
    changed_keys, _ = checked_broadcast(changes.select(*keys).distinct(), max_broadcast_rows)
    untouched = existing.join(changed_keys, keys, "left_anti")
    touched = (existing.join(changed_keys, keys, "left_semi").withColumn("_is_change", F.lit(0))
               .unionByName(changes.withColumn("_is_change", F.lit(1))))
    return untouched.unionByName(latest_per_key(touched, keys, version, tie="_is_change"))
