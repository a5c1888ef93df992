"""Access-log line parsing with JVM regex functions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The access-log line pattern and its timestamp format.
#   host - - [dd/MMM/yyyy:HH:mm:ss +zzzz] "METHOD path HTTP/d.d" status bytes
LOG_PATTERN = r'^(\S+) - - \[(\S+) [+-]\d+\] "[A-Z]+ (\S+) HTTP/\d\.\d" \d+ (\d+)$'
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"

def log_wall_clock(stamp):
    """``dd/MMM/yyyy:HH:mm:ss`` → timestamp without time zone, NULL if invalid.

    The stamp is parsed with an explicit +0000 zone and its epoch seconds
    are added to the zone-free epoch, so the session time zone never shifts
    it (no daylight-saving gaps) and a malformed stamp is NULL, not an error.
    """
    instant = F.try_to_timestamp(F.concat(stamp, F.lit(" +0000")), F.lit(LOG_TIME_FORMAT + " Z"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")   # a string cast carries no zone
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)


def parse_log_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """(host, datetime, path, bytes); lines that do not match are dropped.

    One regex pass per line: a matching line is rewritten into its four
    groups joined by a space (no group can hold one: they are \\S+ / \\d+),
    a non-matching line comes back unchanged and is filtered out.
    The zone offset is matched but not applied: ``datetime`` is the wall
    clock as written (timestamp without time zone). Bytes are 64-bit.
    """
    sep = " "
    v = F.col(col)
    rewritten = F.regexp_replace(v, LOG_PATTERN, f"$1{sep}$2{sep}$3{sep}$4")
    matched = (lines.select(v.alias("_line"), rewritten.alias("_groups"))
               .where(F.col("_groups") != F.col("_line"))
               .select(F.split("_groups", sep, -1).alias("_g")))
    parsed = matched.select(
        F.col("_g")[0].alias("host"),
        log_wall_clock(F.col("_g")[1]).alias("datetime"),
        F.col("_g")[2].alias("path"),
        F.col("_g")[3].try_cast("long").alias("bytes"),
    )
    return parsed.where(F.col("datetime").isNotNull() & F.col("bytes").isNotNull())


def host_request_bytes(logs: DataFrame) -> DataFrame:
    """Per host: x = number of requests, y = total bytes."""
    return logs.groupBy("host").agg(
        F.count(F.lit(1)).alias("x"), F.sum("bytes").alias("y"))
