"""Readers: every file read takes a declared schema (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_text(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Lines of a file or directory as ``value``; gzip/bz2 codecs chosen by extension.

    A gzip file is one split; ``min_partitions`` spreads such input with a
    round-robin repartition right after the scan.
    """
    df = spark.read.text(path)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
             header: bool = False, mode: str = "PERMISSIVE") -> DataFrame:
    """Headerless by default; an empty field is NULL. Filters on the result are evaluated by the scan as soon as
    a line's fields up to the tested one are parsed; ``mode`` says what a malformed line does that gets further."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", mode).csv(path)


def read_delimited_with_file(spark: SparkSession, path: str, schema: T.StructType | str,
                             sep: str = " ", file_col: str = "filename") -> DataFrame:
    """Delimited rows plus the path of the file each row came from.

    ``_metadata.file_path`` is attached at the scan, so it stays correct
    whatever shuffles follow.
    """
    df = spark.read.schema(schema).option("sep", sep).csv(path)
    cols = [c for c in df.columns]
    return df.select(*cols, F.col("_metadata.file_path").alias(file_col))


def read_table(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """Any DataSource by format name (a connector table, Parquet, Delta, ...)."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def range_source(spark: SparkSession, n: int, partitions: int) -> DataFrame:
    """Ids 0..n-1 spread over ``partitions`` tasks."""
    return spark.range(0, n, 1, partitions)


def graph_edges(lines: DataFrame, col: str = "value") -> DataFrame:
    """``node: n1 n2 ...`` lines → (node, neighbour) rows; empty names dropped."""
    parts = F.split(F.col(col), r":\s?", -1)
    rows = lines.select(parts.alias("_p")).where(F.size("_p") > 1)
    out = rows.select(F.col("_p")[0].alias("node"),
                      F.explode(F.split(F.col("_p")[1], " ", -1)).alias("neighbour"))
    return out.where(F.col("neighbour") != "")


def adjacency_lines(edges: DataFrame, node: str = "node", neighbour: str = "neighbour",
                    per_line: int = 1000) -> DataFrame:
    """Inverse of ``graph_edges``: ``node: n1 n2 ...`` lines of at most ``per_line`` names.

    A node with many neighbours is written as several lines (the parser
    reads each line's edges), so no single row gathers a hot node's list.
    """
    # ids follow a local sort, so a recomputed task chunks its rows identically
    chunk = F.floor(F.monotonically_increasing_id() / per_line)
    grouped = edges.select(node, neighbour).sortWithinPartitions(node, neighbour) \
        .select(node, neighbour, chunk.alias("_c")).groupBy(node, "_c").agg(
        F.array_join(F.sort_array(F.collect_list(F.col(neighbour).cast("string"))), " ").alias("_n"))
    return grouped.select(F.concat(F.col(node).cast("string"), F.lit(": "), F.col("_n")).alias("value"))
