"""Whole results at a path, replaced version by version.

A version is a folder of Parquet files under ``<path>/_versions``; the file
``<path>/_current`` names the one that counts and is replaced by an atomic
rename. A reader sees the result of before or of after, never a part, also when
the writer dies in between. A version is kept until the one after its
successor is there, for readers that have just looked it up.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import remove_path


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file next to ``path`` and rename it over it."""
    jvm = spark._jvm
    target, fs = _file_system(spark, path)
    part, _ = _file_system(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(part), fs.makeQualified(target), how)


def current_version(spark: SparkSession, path: str) -> dict | None:
    """What the pointer at ``path`` says (``folder`` and the writer's own entries); None before the first commit."""
    at, fs = _file_system(spark, f"{path}/_current")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit_version(df: DataFrame, path: str, **entries) -> None:
    """Write ``df`` as a new version and let ``path`` stand for it; ``entries`` (e.g. an epoch) go into the pointer."""
    spark = df.sparkSession
    before = current_version(spark, path)
    folder = f"_versions/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    _replace_file(spark, f"{path}/_current", json.dumps({**entries, "folder": folder, "before": before and before["folder"]}))
    if before and before["before"]:
        remove_path(spark, f"{path}/{before['before']}")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The result that ``path`` stands for now."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing was committed at {path}")
    return spark.read.parquet(f"{path}/{version['folder']}")
