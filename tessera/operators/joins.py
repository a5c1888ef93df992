"""Joins whose strategy depends on a checked size, and the relative-score job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# A side is broadcast only when its row count and its measured size, both
# taken on the materialised side, are within these bounds.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 128 << 20


def _width(field: T.StructField) -> Column:
    """Bytes of a value in an in-memory row: 16 for a fixed-size type (a decimal's are the most), a string's own
    on top of that; nested values count with their JSON text."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.UserDefinedType, T.VariantType)):
        return F.octet_length(F.to_json(F.struct(c))) + 16
    return F.lit(16)


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a DataFrame in one job; the bytes over-estimate its in-memory width."""
    width = reduce(Column.__add__, [_width(f) for f in df.schema])
    r = df.agg(F.count(F.lit(1)), F.sum(width.cast("long"))).first()
    return int(r[0]), int(r[1] or 0)


def fits_broadcast(rows: int, nbytes: int, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    return rows <= max_rows and nbytes <= max_bytes


def checked_broadcast(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Materialise ``small`` once, measure it, and mark it for broadcast if it fits.

    Rows and bytes are measured on the checkpointed rows, so the side is
    computed once whichever way the join goes. Beyond either bound the side
    is returned unmarked and Spark plans a shuffle join (sort-merge, with
    AQE skew splitting).
    """
    side = materialize(small)
    if fits_broadcast(*measure(side), max_rows, max_bytes):
        return F.broadcast(side), True
    return side, False


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner",
                 max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    side, _ = checked_broadcast(small, max_rows)
    return big.join(side, on, how)


def relative_score(df: DataFrame, key: str, score: str, author: str,
                   broadcast_averages: bool = False,
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Each row's ``score / avg(score of its key)`` for keys whose average is > 0.

    The averages are a partial+final aggregate (one row per key) joined
    back to the rows; groups with average <= 0 are absent (inner join).
    The broadcast form ships the averages to every task when their checked
    row count allows it. Otherwise they are materialised first: an aggregate
    hashed on the join's own key would keep AQE from splitting a hot key.
    """
    averages = (df.groupBy(key).agg(F.avg(score).alias("_avg"))
                .where(F.col("_avg") > 0))
    if broadcast_averages:
        averages, _ = checked_broadcast(averages, max_broadcast_rows)
    else:
        averages = materialize(averages)  # a plain input under the join's shuffle: AQE can split a hot key
    joined = df.select(key, score, author).join(averages, key, "inner")
    return joined.select(
        (F.col(score) / F.col("_avg")).alias("relative_score"),
        F.col(author).alias("author"),
        F.col(key).alias("key"),
    )


def null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def membership_flag(df: DataFrame, probe: Column, members: DataFrame, member_col: str,
                    out: str, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``CAST(probe IN (SELECT member_col FROM members) AS INT)`` as a column ``out``.

    A left join to the distinct, non-NULL member set (broadcast after a
    row-count check). A NULL probe gives NULL; otherwise 1 if found, else 0
    (NULLs inside the set never match).
    """
    m = members.select(F.col(member_col).alias("_m")).where(F.col("_m").isNotNull()).distinct()
    m, _ = checked_broadcast(m, max_broadcast_rows)
    tagged = df.withColumn("_probe", probe)
    joined = tagged.join(m, tagged["_probe"] == m["_m"], "left")
    flag = (F.when(F.col("_probe").isNull(), F.lit(None))
            .when(F.col("_m").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("int"))
    return joined.withColumn(out, flag).drop("_probe", "_m")
