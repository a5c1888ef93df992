"""Sources and sinks: each query writes driver-table data in a format to a fresh
shared scratch path, reads it back with a declared schema and runs the job on it."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions.json import decode_json_lines
from ..functions.logs import host_request_bytes
from ..functions.paths import path_to_hour
from ..functions.text import WORD_SEPARATORS, format_pair
from ..operators import aggregates as agg
from ..operators.extremes import keep_max_semi
from ..operators.weather import weather_etl
from ..session import materialize, scratch_path, table
from ..sources.batched import BatchedRows
from ..sources.files import (range_source, read_csv, read_delimited_with_file, read_json,
                             read_table, read_text)
from ..sources.keyed_table import KeyedTable
from ..sources.sinks import (json_array_line, write_csv, write_json, write_n_files,
                             write_single_file, write_table, write_text)
from .basic import POINT_KEYS
from .fixtures import (LOGS_SQL, PAGES_SQL, WEATHER_SQL, comments, english_pages, page_counts,
                       weather_observations)
from .logs import staged_logs
from .registry import register

R = 4

WEATHER_SCHEMA = ("station string, date string, observation string, value int, "
                  "mflag string, qflag string, sflag string, obstime string")
COMMENT_SCHEMA = "subreddit string, score double, author string, archived boolean, gilded long"
PAGE_SCHEMA = "language string, title string, views long, size long"

AVG_BY_SEGMENT_SQL = f"""
SELECT c_mktsegment AS subreddit, round(avg(c_acctbal - 4500), {R}) AS average, count(*) AS n
FROM customer GROUP BY c_mktsegment
"""


@register("src_text", """
SELECT printf('%d|%s|%.2f', c_custkey, c_name, c_acctbal) AS value FROM customer
""")
def src_text(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = write_text(F.format_string("%d|%s|%.2f", "c_custkey", "c_name", "c_acctbal"),
                      scratch_path(spark, "text"), df=c)
    return read_text(spark, path)


@register("src_json", AVG_BY_SEGMENT_SQL)
def src_json(spark, sf_dir):
    """JSON lines read with a declared schema (fields absent from the data are NULL);
    then the DataFrame mean per key. Only ``subreddit, score`` reach the scan."""
    path = write_json(comments(spark, sf_dir), scratch_path(spark, "json"), compression=None)
    df = read_json(spark, path, COMMENT_SCHEMA)
    return df.groupBy("subreddit").agg(F.round(F.avg("score"), R).alias("average"),
                                       F.count(F.lit(1)).alias("n"))


@register("json_decode", f"""
SELECT a.*, (SELECT count(*) FROM customer WHERE c_custkey % 10 = 0) AS corrupt_lines FROM ({AVG_BY_SEGMENT_SQL}) a
""")
def json_decode(spark, sf_dir):
    """Per-line JSON decode of text; the score is read as text and converted with
    ``try_cast``, so ``"5"`` and ``5`` both count and a malformed value is NULL.
    Negative scores are written as quoted strings to exercise that path; every
    tenth customer also adds a broken line, and the result says how many were found."""
    c = comments(spark, sf_dir)
    score_txt = F.when(F.col("score") < 0, F.format_string('"%s"', F.col("score").cast("string"))) \
                 .otherwise(F.col("score").cast("string"))
    base = F.to_json(F.struct("subreddit", "author"))
    line = F.regexp_replace(base, r"\}$", F.concat(F.lit(', "score": '), score_txt, F.lit("}")))
    broken = table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select(
        F.concat(F.lit('{"subreddit": "'), F.col("c_name")).alias("value"))
    path = write_text(c.select(line.alias("value")).unionByName(broken), scratch_path(spark, "jsonl"))
    decoded = decode_json_lines(read_text(spark, path), "subreddit string, score string, author string")
    # one pass: the corrupt lines are a group of their own, then a column next to the others
    keyed = decoded.select(F.col("_corrupt"), F.when(~F.col("_corrupt"), F.col("subreddit")).alias("subreddit"),
                           F.col("score").try_cast("double").alias("score"))
    groups = materialize(keyed.groupBy("_corrupt", "subreddit").agg(F.round(F.avg("score"), R).alias("average"),
                                                                    F.count(F.lit(1)).alias("n")))
    lost = groups.agg(F.coalesce(F.sum(F.when(F.col("_corrupt"), F.col("n"))), F.lit(0)).alias("corrupt_lines"))
    return groups.where("NOT _corrupt").join(F.broadcast(lost)).select("subreddit", "average", "n", "corrupt_lines")


WEATHER_ETL_SQL = f"""
WITH {WEATHER_SQL}
SELECT station, date, value / 10 AS tmax FROM weather
WHERE qflag IS NULL AND starts_with(station, '1') AND observation = 'TMAX'
"""


@register("src_csv", WEATHER_ETL_SQL)
def src_csv(spark, sf_dir):
    """Headerless CSV with a declared 8-field schema; empty fields read as NULL."""
    path = write_csv(weather_observations(spark, sf_dir), scratch_path(spark, "csv"))
    return weather_etl(read_csv(spark, path, WEATHER_SCHEMA), station_prefix="1")


def _pagecount_files(spark, sf_dir):
    """Space-delimited page counts, one directory per hour named pagecounts-YYYYMMDD-HH0000."""
    pc = page_counts(spark, sf_dir).select(
        "language", "title", "views", "size",
        F.concat(F.lit("pagecounts-"), F.col("stamp"), F.lit("0000")).alias("file"))
    path = scratch_path(spark, "pagecounts")
    # rebalance on the directory key: few files per hour, and AQE splits a heavy hour
    pc.hint("rebalance", "file").write.mode("overwrite").partitionBy("file").option("sep", " ").csv(path)
    return path


HOURLY_SQL = """
SELECT CASE WHEN event_type = 'click' THEN 'en' ELSE 'fr' END AS language,
       CASE WHEN user_id = 7 THEN 'Main_Page' ELSE CAST(user_id AS VARCHAR) END AS title,
       CAST(floor(value) AS BIGINT) AS views, event_id AS size, strftime(ts, '%Y%m%d-%H') AS hour
FROM events"""


@register("src_delimited_with_file", HOURLY_SQL)
def src_delimited_with_file(spark, sf_dir):
    df = read_delimited_with_file(spark, _pagecount_files(spark, sf_dir), PAGE_SCHEMA, sep=" ")
    return df.select("language", "title", "views", "size", path_to_hour(F.col("filename")).alias("hour"))


@register("path_to_hour", f"""
WITH p AS ({HOURLY_SQL}),
wiki AS (SELECT hour, title, views FROM p
         WHERE language = 'en' AND NOT starts_with(title, 'Special:') AND title <> 'Main_Page')
SELECT hour, title, views FROM wiki w
WHERE views = (SELECT max(views) FROM wiki w2 WHERE w2.hour = w.hour)
""")
def path_to_hour_q(spark, sf_dir):
    """Most-viewed English pages per hour, the hour taken from each row's file name."""
    df = read_delimited_with_file(spark, _pagecount_files(spark, sf_dir), PAGE_SCHEMA, sep=" ")
    wiki = df.select("language", "title", "views", path_to_hour(F.col("filename")).alias("hour")).where(
        (F.col("language") == "en") & ~F.col("title").startswith("Special:") & (F.col("title") != "Main_Page"))
    return keep_max_semi(wiki.select("hour", "title", "views"), ["hour"], "views").orderBy("hour", "title")


@register("src_gzip", f"""
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), {R}) AS sum_qty FROM lineitem GROUP BY l_returnflag
""")
def src_gzip(spark, sf_dir):
    """Gzip CSV parts (unsplittable: one task per file) read back with a schema."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    path = write_csv(li, scratch_path(spark, "gzcsv"), compression="gzip")
    df = read_csv(spark, path, "l_orderkey long, l_returnflag string, l_quantity double")
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                          F.round(F.sum("l_quantity"), R).alias("sum_qty"))


PUSHDOWN_WHERE = ("l_returnflag = 'R' AND l_quantity < 10 AND l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'")


@register("src_pushdown_filter", f"""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE {PUSHDOWN_WHERE}
""")
def src_pushdown_filter(spark, sf_dir):
    """Filters evaluated by the scan: the plan lists them under PushedFilters and
    reads only the projected columns (ReadSchema)."""
    li = table(spark, sf_dir, "lineitem")
    return li.where(F.expr(PUSHDOWN_WHERE)).select("l_orderkey", "l_linenumber", "l_quantity")


CSV_WHERE = "l_returnflag = 'R' AND l_quantity < 10 AND l_shipdate >= '1996-01-01'"


@register("src_csv_pushdown", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity < 10 AND l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'
""")
def src_csv_pushdown(spark, sf_dir):
    """Filters evaluated inside a gzip CSV scan (``PushedFilters`` on the CSV node). Lines of other return flags
    hold no number where the quantity belongs: the scan skips them before it converts their further fields, so
    even a scan that fails on malformed lines (FAILFAST) reads the file."""
    quantity = F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("string")).otherwise("n/a")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", quantity.alias("l_quantity"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
        "l_orderkey", "l_linenumber")
    path = write_csv(lines, scratch_path(spark, "pushcsv"), compression="gzip")
    schema = "l_returnflag string, l_quantity double, l_shipdate string, l_orderkey long, l_linenumber long"
    return read_csv(spark, path, schema, mode="FAILFAST").where(CSV_WHERE).select("l_orderkey", "l_linenumber", "l_quantity")


@register("src_table_connector", f"""
WITH {LOGS_SQL}
SELECT host, count(*) AS x, CAST(sum(bytes) AS BIGINT) AS y FROM logs GROUP BY host
""")
def src_table_connector(spark, sf_dir):
    """A keyed log table reached only through a DataSource format name and options."""
    path = scratch_path(spark, "logtable")
    write_table(staged_logs(spark, sf_dir), "parquet", mode="append", path=path)
    return host_request_bytes(read_table(spark, "parquet", path))


@register("src_range", """
SELECT i AS part, CAST((i + 1) * n // 8 - i * n // 8 AS BIGINT) AS rows
FROM range(8) t(i), (SELECT count(*) AS n FROM orders) c
""")
def src_range(spark, sf_dir):
    """Integer range with a chosen partition count (as many ids as orders rows)."""
    n = table(spark, sf_dir, "orders").count()
    ids = range_source(spark, n, 8)
    return ids.groupBy(F.spark_partition_id().cast("long").alias("part")).agg(
        F.count(F.lit(1)).alias("rows"))


@register("src_rows", f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey IN ({', '.join(map(str, POINT_KEYS))})
""")
def src_rows(spark, sf_dir):
    """In-memory rows with a schema, joined to a table (broadcast: fixed small size)."""
    keys = spark.createDataFrame([(k,) for k in POINT_KEYS], "o_orderkey long")
    o = table(spark, sf_dir, "orders")
    return o.join(F.broadcast(keys), "o_orderkey", "left_semi").select("o_orderkey", "o_custkey", "o_totalprice")


@register("src_external_table", f"""
SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS pdate, round(avg(o_totalprice), {R}) AS avg
FROM orders
WHERE date_part('month', o_orderdate) = 8 AND date_part('day', o_orderdate) < 6
GROUP BY 1
""")
def src_external_table(spark, sf_dir):
    """Table defined over files at a location (schema on read), queried in SQL.

    GROUP BY / ORDER BY use the select alias ``pdate``; no input column has
    that name, so the alias (the day) is the grouping key, not the timestamp.
    """
    path = scratch_path(spark, "purchases")
    table(spark, sf_dir, "orders").write.mode("overwrite").parquet(path)
    name = "ext_purchases_" + os.path.basename(path).replace("-", "_")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    daily = spark.sql(f"""
        SELECT date_format(CAST(o_orderdate AS DATE), 'yyyy-MM-dd') AS pdate, round(avg(o_totalprice), {R}) AS avg
        FROM {name}
        WHERE date_part('mon', o_orderdate) = 8 AND date_part('d', o_orderdate) < 6
        GROUP BY pdate
        ORDER BY pdate""")
    spark.sql(f"DROP TABLE {name}")  # the definition only: the files stay, and the result already names them
    return daily


@register("sink_text", f"""
WITH t AS (SELECT unnest(regexp_split_to_array(lower(text), '{WORD_SEPARATORS}')) AS word FROM documents)
SELECT printf('%s %d', word, count(*)) AS value FROM t WHERE word <> '' GROUP BY word
""")
def sink_text(spark, sf_dir):
    """Sorted ``word count`` lines written as text parts, read back."""
    counts = agg.word_count(table(spark, sf_dir, "documents"), "text").orderBy("word")
    path = write_text(format_pair(F.col("word"), F.col("count")), scratch_path(spark, "wc"), df=counts)
    return read_text(spark, path)


@register("sink_json_array", """
SELECT '[' || to_json(c_mktsegment) || ', ' || CAST(round(c_acctbal - 4500, 2) AS VARCHAR) || ', '
       || to_json(c_name) || ']' AS value
FROM customer WHERE contains(c_mktsegment, 'E')
""")
def sink_json_array(spark, sf_dir):
    """Each record as a JSON array line ``["key", number, "name"]``."""
    c = comments(spark, sf_dir).where(F.col("subreddit").contains("E"))
    line = json_array_line(F.col("subreddit"), F.round("score", 2), F.col("author"))
    return read_text(spark, write_text(line, scratch_path(spark, "jsonarr"), df=c))


@register("sink_json", WEATHER_ETL_SQL)
def sink_json(spark, sf_dir):
    """Gzip JSON, overwrite mode; read back with the declared output schema."""
    out = weather_etl(weather_observations(spark, sf_dir), station_prefix="1")
    path = write_json(out, scratch_path(spark, "weather"), compression="gzip")
    return read_json(spark, path, "station string, date string, tmax double")


@register("sink_csv", AVG_BY_SEGMENT_SQL)
def sink_csv(spark, sf_dir):
    c = comments(spark, sf_dir)
    avg = c.groupBy("subreddit").agg(F.round(F.avg("score"), R).alias("average"), F.count(F.lit(1)).alias("n"))
    path = write_csv(avg, scratch_path(spark, "avgcsv"))
    return read_csv(spark, path, "subreddit string, average double, n long")


@register("sink_single_file", f"""
WITH {PAGES_SQL}
SELECT hour, title, views, 1 AS files FROM wiki w
WHERE views = (SELECT max(views) FROM wiki w2 WHERE w2.hour = w.hour)
""")
def sink_single_file(spark, sf_dir):
    """A small sorted result written as one part file (one task writes it)."""
    best = keep_max_semi(english_pages(spark, sf_dir), ["hour"], "views").orderBy("hour", "title")
    path = write_single_file(best, scratch_path(spark, "single"), "json")
    back = read_json(spark, path, "hour string, title string, views long")
    n_files = back.select(F.col("_metadata.file_name")).distinct().count()
    return back.withColumn("files", F.lit(n_files))


@register("sink_table_append", f"""
WITH {LOGS_SQL}
SELECT host, count(*) AS x, CAST(sum(bytes) AS BIGINT) AS y FROM logs GROUP BY host
""")
def sink_table_append(spark, sf_dir):
    """Two appends through a format name (first and second half of the month);
    the table afterwards holds every row of both batches."""
    logs = staged_logs(spark, sf_dir)
    path = scratch_path(spark, "append")
    early = F.dayofmonth("datetime") <= 15
    write_table(logs.where(early), "parquet", mode="append", path=path)
    write_table(logs.where(~early), "parquet", mode="append", path=path)
    return host_request_bytes(read_table(spark, "parquet", path))


@register("sink_batched", f"""
WITH {LOGS_SQL}
SELECT host, count(*) AS x, CAST(sum(bytes) AS BIGINT) AS y FROM logs GROUP BY host
""")
def sink_batched(spark, sf_dir):
    """Two appends in batches of 100 rows (first and second half of the month); a task's last,
    smaller batch is written like the others."""
    spark.dataSource.register(BatchedRows)
    logs = staged_logs(spark, sf_dir)
    path = scratch_path(spark, "batched")
    early = F.dayofmonth("datetime") <= 15
    for half in (logs.where(early), logs.where(~early)):
        write_table(half, "batched_rows", mode="append", path=path, batch_rows=100)
    return host_request_bytes(spark.read.format("batched_rows").schema(logs.schema).load(path))


@register("sink_n_files", f"""
WITH {LOGS_SQL}
SELECT host, count(*) AS x, CAST(sum(bytes) AS BIGINT) AS y FROM logs GROUP BY host
""")
def sink_n_files(spark, sf_dir):
    """Output with exactly three reducers (hash on the key): at most three part files."""
    path = write_n_files(host_request_bytes(staged_logs(spark, sf_dir)), scratch_path(spark, "nfiles"), 3, "host")
    return spark.read.parquet(path)


@register("upsert_by_key", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders
""")
def upsert_by_key_q(spark, sf_dir):
    """Open orders are re-sent closed with a new price (version 2); the keyed
    table then holds one row per order with the newest version."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(1).alias("version"))
    path = scratch_path(spark, "orders")
    orders = KeyedTable.create(spark, os.path.basename(path).replace("-", "_"),
                               "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, version INT",
                               ["o_orderkey"], location=path)
    orders.upsert(o, version="version")
    changes = orders.rows().where(F.col("o_orderstatus") == "O").select(
        "o_orderkey", F.lit("F").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.lit(2).alias("version"))
    orders.upsert(changes, version="version")
    orders.vacuum()
    return orders.rows().select("o_orderkey", "o_orderstatus", "o_totalprice")


@register("keyed_log_table", f"""
WITH {LOGS_SQL}
SELECT host, path, strftime(max(datetime), '%Y-%m-%d %H:%M:%S') AS datetime,
       max(bytes) FILTER (datetime = last) AS bytes
FROM (SELECT *, max(datetime) OVER (PARTITION BY host, path) AS last FROM logs)
GROUP BY host, path
""")
def keyed_log_table(spark, sf_dir):
    """A log table with the compound key (host, path), loaded in two batches, the first of them sent again
    at the end: one row a key, the newest request (of equal times the one with most bytes)."""
    logs = staged_logs(spark, sf_dir).select("host", "path", "datetime", "bytes")
    path = scratch_path(spark, "hits")
    hits = KeyedTable.create(spark, os.path.basename(path).replace("-", "_"),
                             "host STRING, path STRING, datetime TIMESTAMP_NTZ, bytes BIGINT", ["host", "path"], location=path)
    early = F.dayofmonth("datetime") <= 15
    for batch in (logs.where(early), logs.where(~early), logs.where(early)):
        hits.upsert(batch, version="datetime")
    hits.vacuum()
    return hits.rows().select("host", "path", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"), "bytes")
