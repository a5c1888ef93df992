"""Streaming simple linear regression over "x y" messages.

The aggregate is global (one group) with constant-size state — the
running count and sums behind ``regr_slope`` / ``regr_intercept`` — so
state does not grow with the stream. Complete output mode re-emits the
single result row every micro-batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path
from .commits import commit_version, current_version


#: Bytes of new files that a micro-batch of a file source takes at most.
BATCH_BYTES = 64 << 20


def read_stream(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """Any streaming source by format name; a message broker passes its options
    (servers, topic, ``maxOffsetsPerTrigger``); file sources take a path.
    ``value`` is cast to string.

    Micro-batches are cut by the source's offsets and limited in bytes
    (``maxBytesPerTrigger``, for file sources 64 MB if not given), so a backlog
    of any size is taken in portions and a restart goes on after the last
    portion in the offset log.
    """
    if path:
        options = {"maxBytesPerTrigger": BATCH_BYTES, **options}
    reader = spark.readStream.format(fmt).options(**options)
    df = reader.load(path) if path else reader.load()
    return df.select(F.col("value").cast("string").alias("value"))


def parse_points(messages: DataFrame, col: str = "value") -> DataFrame:
    """``"x y"`` → (x, y) doubles; a missing or malformed side is NULL."""
    parts = F.split(F.col(col), " ", -1)
    return messages.select(
        F.try_element_at(parts, F.lit(1)).try_cast("double").alias("x"),
        F.try_element_at(parts, F.lit(2)).try_cast("double").alias("y"),
    )


def regression_state(points: DataFrame) -> DataFrame:
    """beta (slope) and alpha (intercept) of y on x since the stream started;
    pairs with a NULL side are ignored."""
    return points.agg(
        F.regr_count("y", "x").alias("n"),
        F.regr_slope("y", "x").alias("beta"),
        F.regr_intercept("y", "x").alias("alpha"),
    )


def start_regression(spark: SparkSession, messages: DataFrame, checkpoint: str | None = None,
                     sink: str = "memory", query_name: str | None = None,
                     available_now: bool = True, table_path: str | None = None,
                     **sink_options) -> StreamingQuery:
    """Start the streaming query in complete mode; the caller awaits or stops it.

    ``sink`` is a streaming format (``memory``, ``console``) or ``"table"``:
    file sinks only append, so each micro-batch commits the complete result as
    a new version at ``table_path`` (``read_current`` reads it). A micro-batch
    that runs again after a crash commits the same result again; one of an
    epoch below the committed one of the same checkpoint is left out.
    """
    result = regression_state(parse_points(messages))
    name = query_name or f"regression_{uuid.uuid4().hex[:12]}"
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    w = result.writeStream.outputMode("complete").queryName(name).option("checkpointLocation", checkpoint)
    if sink == "table":
        def replace_table(batch: DataFrame, epoch: int) -> None:
            committed = current_version(batch.sparkSession, table_path)
            if not committed or committed["checkpoint"] != checkpoint or committed["epoch"] <= epoch:
                commit_version(batch, table_path, epoch=epoch, checkpoint=checkpoint)
        w = w.foreachBatch(replace_table)
    else:
        w = w.format(sink)
    for k, v in sink_options.items():
        w = w.option(k, v)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
