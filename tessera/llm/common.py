"""Shared helpers: table access, staged intermediates, ASCII rules of the contracts."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, table

#: White space of every contract here: space and U+0009 to U+000D.
ASCII_SPACE = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    It cuts the lineage (a lost executor re-reads files instead of
    recomputing), gives AQE a plain scan so that joins on hot keys can be
    split, and fixes the row order of sorted data.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts (as many bytes as characters) take the fast path."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def word_count(c: Column) -> Column:
    """Number of maximal runs without white space, as a long."""
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def stage_sorted(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Range-partition and sort by ``order``, add (``_pid``, ``_pos``), stage.

    The partition number and the row's place in it come from the partition
    id of the sorted stage, so a later prefix sum over the (few) partitions
    turns them into exact global ranks without any single-task sort.
    """
    mid = F.monotonically_increasing_id()
    out = (df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
           .withColumn("_mid", mid)
           .withColumn("_pid", F.shiftright("_mid", 33).cast("int"))
           .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
           .drop("_mid"))
    return stage(out, name)


def slices(batch, sizes, max_bytes: int = 1 << 20):
    """Cut an Arrow batch into zero-copy slices of about ``max_bytes`` (at least one row each),
    so that a Python task's arrays stay small whatever the batch size."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)
