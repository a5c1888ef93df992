"""File-path helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: page-count files are named pagecounts-YYYYMMDD-HHMMSS...;
# the hour key is YYYYMMDD-HH.
HOUR_IN_PATH = r"pagecounts-(\d{8}-\d{2})\d{4}"


def path_to_hour(path: Column) -> Column:
    """``.../pagecounts-20160801-120000.gz`` → ``20160801-12``.

    Works on the full path, so it also finds the name when it is a
    directory level (as written by a partitioned Spark sink).
    """
    return F.regexp_extract(path, HOUR_IN_PATH, 1)


def file_name(path: Column) -> Column:
    """Last path segment."""
    return F.element_at(F.split(path, "/"), -1)
