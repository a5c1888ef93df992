"""Streaming regression: the events are staged as "x y" message files and consumed
by a file-source stream that is restarted in between (the broker is a format option)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path, table
from ..streaming.commits import read_current
from ..streaming.regression import read_stream, start_regression
from .registry import register


@register("stream_regression", """
SELECT regr_count(value, user_id) AS n, round(regr_slope(value, user_id), 6) AS beta,
       round(regr_intercept(value, user_id), 6) AS alpha
FROM events
""")
def stream_regression(spark, sf_dir):
    """The events arrive in two portions, as "x y" message files. The stream ends after the first; started again on
    the same checkpoint, it takes up the second where its offset log ends."""
    ev = table(spark, sf_dir, "events")
    msgs = ev.select(F.col("event_type").isin("view", "click").alias("early"), F.concat_ws(
        " ", F.col("user_id").cast("string"), F.col("value").cast("string")).alias("value"))
    src, fit, log = (scratch_path(spark, f"xy-{x}") for x in ("stream", "fit", "log"))
    for portion in (msgs.where(F.coalesce("early", F.lit(False))), msgs.where(~F.coalesce("early", F.lit(False)))):
        portion.select("value").write.mode("append").text(src)
        q = start_regression(spark, read_stream(spark, "text", src), checkpoint=log, sink="table", table_path=fit)
        q.awaitTermination()
    return read_current(spark, fit).select(F.col("n").cast("long").alias("n"), F.round("beta", 6).alias("beta"),
                                           F.round("alpha", 6).alias("alpha"))
