"""Exact dedup by content sort (native: DataFrame functions only).

Sampled splitters range-partition the rows by content (the text's beginning,
then its hash), an external sort puts equal texts side by side, and the window
over neighbouring equal texts compares them in full and picks the row that stays.

A text that holds a large share of all rows would end in one range. Such
texts are found first from a map-side combined count of 64-bit hashes (at
most ``4 * partitions`` hashes can pass the threshold, so that list has a
proven bound and may be broadcast). They are dealt over ``salts`` sub-ranges
by the rows' places in the input, whatever their ids, and the sub-ranges of a
hot text are merged by SHA-256.

Defined results: a null text counts as empty; a null id sorts after every
other id (it stays only if all ids of its group are null); of rows that
agree in text and id exactly one stays; an empty table gives an empty result;
other input columns are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stage, text_or_empty


def hot_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """Hashes of texts that hold more than 1/(4P) of the rows (at most 4P of them)."""
    share = max(1000, docs.count() // (4 * partitions(docs.sparkSession)))
    return (docs.select(F.xxhash64(text_or_empty(text_col)).alias("_hot"))
            .groupBy("_hot").count().where(F.col("count") > share).select("_hot"))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                payload: list[str] | None = None, keep: str = "max", salts: int = 64) -> DataFrame:
    """One row per input row: ``_id, _keep, _size, _kept, _sha`` and, with ``payload``, ``_row``.

    ``payload`` names input columns that come back in the struct ``_row``;
    ``keep`` says whether the largest ("max") or smallest ("min") id stays.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep is 'max' or 'min'")
    best = F.max if keep == "max" else F.min
    rest = [c for c in payload or [] if c != text_col]
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("_id"), text.alias("_t"), F.col(text_col).isNull().alias("_null"),
        F.monotonically_increasing_id().alias("_place"),
        *([F.struct(*rest).alias("_rest")] if rest else []))
    rows = (rows.withColumn("_hash", F.xxhash64("_t"))
            .join(F.broadcast(hot_texts(docs, text_col)), F.col("_hash") == F.col("_hot"), "left")
            .withColumn("_salt", F.when(F.col("_hot").isNull(), F.lit(0))
                        .otherwise(F.pmod(F.xxhash64("_place"), F.lit(salts))).cast("int"))
            .drop("_place"))
    # Splitters are sampled by the driver: they hold the text's beginning and its hash, not the text.
    place = ["_start", "_hash", "_salt"]
    ranged = rows.withColumn("_start", F.substring("_t", 1, 32)).repartitionByRange(partitions(docs.sparkSession), *place)
    same = Window.partitionBy(*place, "_t")  # the range partitioning satisfies it: no second exchange
    by_id = F.col("_id").desc_nulls_last() if keep == "max" else F.col("_id").asc_nulls_last()
    marked = (ranged
              .withColumn("_n", F.row_number().over(same.orderBy(by_id)))
              .withColumn("_sub_size", F.count(F.lit(1)).over(same))
              .withColumn("_sub_keep", best("_id").over(same)))
    back = []
    if payload is not None:
        whole = F.when(~F.col("_null"), F.col("_t")).alias(text_col)
        back = [F.struct(*[whole if c == text_col else F.col("_rest").getField(c).alias(c)
                           for c in payload]).alias("_row")]
    if payload is not None:
        # Only the first of each sub-range can stay, so the copies' texts end here.
        marked = marked.where(F.col("_n") == 1)
    marked = stage(marked.select("_id", F.sha2(F.col("_t"), 256).alias("_sha"), F.col("_hot").isNotNull().alias("_is_hot"),
                                 "_salt", "_n", "_sub_size", "_sub_keep", *back), "exact")
    hot = marked.where("_is_hot")
    # the best id, and of the sub-ranges that hold it the first: exactly one row stays
    if keep == "max":
        first = F.max(F.struct(F.col("_sub_keep").alias("id"), (-F.col("_salt")).alias("at")))
    else:
        first = F.min(F.struct(F.col("_sub_keep").isNull().alias("none"), F.col("_sub_keep").alias("id"), F.col("_salt").alias("at")))
    totals = (hot.where(F.col("_n") == 1).groupBy(F.col("_sha").alias("_sha2"))
              .agg(first.alias("_first"), F.sum("_sub_size").alias("_all_size"))
              .select("_sha2", "_all_size", F.col("_first.id").alias("_all_keep"), F.abs("_first.at").alias("_at")))
    carried = ["_row"] if payload is not None else []
    hot_out = hot.join(F.broadcast(totals), F.col("_sha") == F.col("_sha2")).select(
        "_id", F.col("_all_keep").alias("_keep"), F.col("_all_size").alias("_size"),
        ((F.col("_n") == 1) & (F.col("_salt") == F.col("_at"))).alias("_kept"), "_sha", *carried)
    cold_out = marked.where("not _is_hot").select(
        "_id", F.col("_sub_keep").alias("_keep"), F.col("_sub_size").alias("_size"),
        (F.col("_n") == 1).alias("_kept"), "_sha", *carried)
    return cold_out.unionAll(hot_out)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """Report: one row per document with the id that stays, its group's size, whether it stays, the text's SHA-256."""
    return mark_copies(docs, id_col, text_col, keep=keep).select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("_kept").alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """``docs`` without the copies, same columns."""
    names = docs.columns
    return (mark_copies(docs, id_col, text_col, payload=names, keep=keep)
            .where("_kept").select(*[F.col("_row").getField(c).alias(c) for c in names]))
