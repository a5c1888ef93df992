"""Bounded, reproducible training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, may_learn: Column, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, text, _y, _weight): about ``max_rows / 2`` training documents of each class at most.

    Ids are drawn by hash, so the sample doesn't depend on the partitioning. A
    row weighs as many documents of its class as it stands for. Labels that are null, not 0/1, without a
    document, or contradicted by another row of the same id are ignored.
    """
    clean = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_y"), F.max(label_col).alias("_y2"))
             .where("_y = _y2").drop("_y2"))
    pool = clean.where(F.coalesce(may_learn, F.lit(False)))
    sizes = {r["_y"]: r["count"] for r in pool.groupBy("_y").count().collect()}  # two rows
    share = {y: min(1.0, max_rows / 2 / max(1, n)) for y, n in sizes.items()}
    rate = F.when(F.col("_y") == 1, F.lit(share.get(1, 1.0))).otherwise(F.lit(share.get(0, 1.0)))
    coin = F.pmod(F.xxhash64("_id", F.lit(42)), F.lit(1 << 30)) / float(1 << 30)
    drawn = pool.where(coin < rate).withColumn("_weight", 1 / rate)  # about max_rows ids: a bounded broadcast
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(drawn), "_id")
