"""Label dictionaries as tables: label → index and back by joins, confusion tables by aggregation.

The dictionary has a row for each distinct label, numbered by falling frequency
(ties alphabetically) with global positions, so neither the labels nor their
order pass through the driver or one task. Both directions are joins with that
table; it is broadcast if its measured size allows it, otherwise it is a plain
side, so that a hot label's rows can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..operators.ordering import sort_with_position


class LabelDictionary:
    def __init__(self, table: DataFrame):
        """``table``: ``word``, ``label`` (0.0 for the most frequent word), ``n`` (rows with it)."""
        self.table, _ = checked_broadcast(table)

    @classmethod
    def of(cls, df: DataFrame, col: str) -> LabelDictionary:
        """All labels of a column; nulls are none."""
        counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("word")).agg(F.count(F.lit(1)).alias("n"))
        ranked = sort_with_position(counts, [F.desc("n"), F.asc("word")], "_rn", unique=True)
        return cls(ranked.select("word", (F.col("_rn") - 1).cast("double").alias("label"), "n"))

    def encode(self, df: DataFrame, col: str, out: str = "label", unseen: float | None = None) -> DataFrame:
        """``df`` with the index of ``col``'s label; ``unseen`` for labels that the dictionary lacks (null by default)."""
        side = self.table.select(F.col("word").alias("_word"), F.col("label").alias("_label"))
        joined = df.join(side, df[col] == side["_word"], "left")
        return joined.withColumn(out, F.coalesce("_label", F.lit(unseen).cast("double"))).drop("_word", "_label")

    def decode(self, df: DataFrame, col: str, out: str = "word") -> DataFrame:
        """``df`` with the label that the index in ``col`` stands for; null if it stands for none."""
        side = self.table.select(F.col("word").alias("_word"), F.col("label").alias("_label"))
        joined = df.join(side, df[col] == side["_label"], "left")
        return joined.withColumn(out, F.col("_word")).drop("_word", "_label")


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n``: rows for each pair that occurs."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def weighted_f1(table: DataFrame) -> DataFrame:
    """Label-frequency weighted F1 (one row, ``f1``) of a confusion table.

    Sums by label and by prediction of a table that has a row for each pair of
    labels at most; a label that is never predicted, or never right, counts 0.
    """
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    true = table.groupBy("label").agg(F.sum("n").alias("n_true"), hit.alias("n_hit"))
    guessed = table.groupBy("prediction").agg(F.sum("n").alias("n_guessed"))
    # 2 p r / (p + r) with p = hit / guessed and r = hit / true
    f1 = 2 * F.col("n_hit") / (F.col("n_true") + F.coalesce("n_guessed", F.lit(0)))
    return true.join(guessed, F.col("label") == F.col("prediction"), "left").agg(
        (F.sum(F.col("n_true") * f1) / F.sum("n_true")).alias("f1"))
