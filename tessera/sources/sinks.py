"""Writers. Each returns the path (or nothing) and leaves the data distributed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_text(lines: DataFrame | Column, path: str, df: DataFrame | None = None,
               compression: str | None = None) -> str:
    """One line per row. ``lines`` is a one-column DataFrame, or a Column over ``df``."""
    out = df.select(lines.alias("value")) if isinstance(lines, Column) else lines
    w = out.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def json_array_line(*cols: Column) -> Column:
    """``[v1, v2, ...]`` text per row, each value JSON-encoded (NULL → null)."""
    def item(c: Column) -> Column:
        whole = F.to_json(F.struct(c.alias("v")))   # {"v":...}, cut by position: a value may hold any line break
        return F.when(c.isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(6), F.char_length(whole) - 6))

    items = [item(c) for c in cols]
    return F.concat(F.lit("["), F.concat_ws(", ", *items), F.lit("]"))


def write_json(df: DataFrame, path: str, compression: str | None = "gzip") -> str:
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.json(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = False, compression: str | None = None) -> str:
    w = df.write.mode("overwrite").option("header", header)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def write_single_file(df: DataFrame, path: str, fmt: str = "json") -> str:
    """One part file (keeps a global sort). Only for small results: one task writes it."""
    df.coalesce(1).write.mode("overwrite").format(fmt).save(path)
    return path


def write_split(df: DataFrame, path: str, by: str, fmt: str = "json",
                compression: str | None = "gzip") -> str:
    """Multiplexed sink: one pass writes ``path/<by>=<value>/`` per value."""
    w = df.write.mode("overwrite").partitionBy(by).format(fmt)
    if compression:
        w = w.option("compression", compression)
    w.save(path)
    return path


def write_n_files(df: DataFrame, path: str, n: int, key: str | None = None, fmt: str = "parquet") -> str:
    """Output with exactly ``n`` reducers (hash on ``key`` if given): at most ``n`` part files.

    ``n == 0`` is the map-only case: rows are written as the upstream tasks
    produce them, with no shuffle (one file per input task).
    """
    if n == 0:
        parts = df
    else:
        parts = df.repartition(n, key) if key else df.repartition(n)
    parts.write.mode("overwrite").format(fmt).save(path)
    return path


def write_table(df: DataFrame, fmt: str, mode: str = "append", path: str | None = None, **options) -> None:
    """Append/overwrite through any DataSource (a connector table, Parquet, ...).

    Batching of inserts is the connector's business (e.g. its batch-size
    option); every row of every partition is written.
    """
    w = df.write.format(fmt).mode(mode).options(**options)
    if path:
        w.save(path)
    else:
        w.save()
