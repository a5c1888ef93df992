"""Line dedup (native: DataFrame functions only).

Every line long enough becomes (key hash, document, position). The rows are
range-partitioned on (key hash, document) and sorted in each range by document
and position, so equal keys stand in order while a key that occurs in a third
of all documents still spreads over many tasks. A pass over the sorted rows
marks each key's first occurrence in a document; these, counted per key
(combined before the shuffle), tell how many documents hold it and which is the
last. What leaves the operator is one compressed bitmap of dropped lines per
document, not text: bit ``i`` (from the left) is line ``i``; trailing zero
bytes are cut, so a document that loses nothing carries an empty bitmap.
``kept_text`` applies the bitmaps.

Keys are compared by two independent 64-bit hashes (128 bits).

Defined results: a null or empty text is one empty line and loses nothing; a
null id counts as one document below every other id; rows with the same id
count as one document, each row losing its own lines; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_SPACE, ascii_lower, partitions, stage, text_or_empty

_SECOND_SEED = 0x5DEECE66D


def line_key(line: Column) -> Column:
    """A line (already lower-cased) without white space at both ends."""
    return F.btrim(line, F.lit(ASCII_SPACE))


def sorted_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc, tag, pos, first): all long lines in the order of their keys, documents and places;
    ``first`` marks a key's first line in a document."""
    lines = docs.select("_doc", "_tag", F.posexplode(F.split(ascii_lower(F.col("_t")), "\n", -1)).alias("_pos", "_line"))
    keys = (lines.select("_doc", "_tag", "_pos", line_key(F.col("_line")).alias("_key"))
            .where(F.char_length("_key") >= min_chars)
            .select("_doc", "_tag", "_pos", F.xxhash64("_key").alias("_h1"),
                    F.xxhash64(F.lit(_SECOND_SEED), F.col("_key")).alias("_h2")))
    # the range partitioning satisfies the window: one exchange, one sort, then a stream over the run
    run = Window.partitionBy("_h1", "_h2", "_doc").orderBy("_tag", "_pos")
    return (keys.repartitionByRange(partitions(docs.sparkSession), "_h1", "_h2", "_doc")
            .withColumn("_first", F.row_number().over(run) == 1))


def drop_bitmaps(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(_doc, _tag, _n_dropped, _bitmap) of the rows that lose lines."""
    lines = stage(sorted_lines(docs, min_chars), "line-runs")
    common = stage(lines.where("_first").groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_docs"), F.max("_doc").alias("_last"))
                   .where(F.col("_docs") >= min_docs), "line-keys")
    lost = lines.join(common.select("_h1", "_h2", "_last"), ["_h1", "_h2"]).where(~F.col("_doc").eqNullSafe(F.col("_last")))
    # rows that agree in id and text lose the same lines; a row gathers no more than its own lines
    drop = lost.groupBy("_doc", "_tag").agg(F.array_sort(F.collect_set("_pos")).alias("_drop"))
    return stage(drop.select("_doc", "_tag", F.size("_drop").cast("long").alias("_n_dropped"), _bitmap(F.col("_drop")).alias("_bitmap")),
                 "line-bitmaps")


def _bitmap(drop: Column) -> Column:
    """Sorted places as bits, eight to a byte, up to the last place's byte."""
    last = F.get(drop, F.size(drop) - 1)
    gap = lambda p, i: p - F.when(i == 0, F.lit(0)).otherwise(F.get(drop, i - 1) + 1)
    flags = F.array_join(F.transform(drop, lambda p, i: F.concat(F.repeat(F.lit("0"), gap(p, i)), F.lit("1"))), "")
    # binary digits by fours are hexadecimal ones
    whole = F.rpad(flags, (F.floor(last / 8).cast("int") + 1) * 8, "0")
    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.floor(last / 8).cast("int")), lambda b: F.lpad(
        F.conv(F.substring(whole, b * 8 + 1, F.lit(8)), 2, 16), 2, "0")), ""))


def kept_text(text: Column, bitmap: Column) -> Column:
    """The lines of ``text`` whose bit isn't set, joined by newlines."""
    hexed = F.hex(bitmap)  # four lines a digit

    def stays(_, i):
        digit = F.conv(F.substring(hexed, F.floor(i / 4).cast("int") + 1, F.lit(1)), 16, 10).cast("int")
        return F.coalesce(F.get(F.array(*[F.lit(8 >> k) for k in range(4)]), i % 4).bitwiseAND(digit) == 0, F.lit(True))

    return F.array_join(F.filter(F.split(text, "\n", -1), stays), "\n")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per row: id, ``n_lines``, ``n_dropped``, ``drop_bitmap`` and ``kept_text`` (what the bitmap leaves)."""
    base = docs.select(F.col(id_col).alias("_doc"), text_or_empty(text_col).alias("_t")).withColumn(
        "_tag", F.xxhash64("_t"))
    lost = drop_bitmaps(base, min_chars, min_docs)
    joined = base.alias("b").join(lost.alias("l"), F.col("b._doc").eqNullSafe(F.col("l._doc"))
                                  & (F.col("b._tag") == F.col("l._tag")), "left")
    return joined.select(
        F.col("b._doc").alias(id_col), F.size(F.split("_t", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce("_n_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.coalesce("_bitmap", F.lit(b"")).alias("drop_bitmap"),
        F.when(F.col("_bitmap").isNull(), F.col("_t")).otherwise(kept_text(F.col("_t"), F.col("_bitmap"))).alias("kept_text"))
