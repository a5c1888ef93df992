"""Mixing sources to target weights (native: DataFrame functions only).

Each source gets a word budget by weight, limited to ``max_epochs`` times its
size. Documents get hash-random keys (MD5 of seed and id), are range-sorted by
(source, key), and distributed prefix sums of their sizes (per partition, then
within it) place each document on its source's line. Each source is cut at
its exact budget: full epochs take everything, the last one takes the leading
documents and only the missing words of the document at the cut.

Defined results: a null text has size 0; the null source is a source of its
own, after all others; documents without words take part with 0 words; rows
with equal ids are taken one by one; an empty table gives an empty result. The
order is a function of seed, id and size only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stage, stage_sorted, text_or_empty, word_count


def source_targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, max_epochs: int) -> DataFrame:
    """``sizes`` (_src, _size) with ``_target``: the weighted share of ``percent`` % of all
    words, no source above ``max_epochs`` times its size and the excess shared anew by weight.

    In the order of size/weight the sources that reach their limit come first,
    so one prefix sum over the sources replaces the rounds of resharing. All
    comparisons are on integers. One row per source passes through the window.
    """
    by_name, by_ratio = Window.orderBy("_src"), Window.orderBy("_ratio", "_src")
    before, every = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    share = (sizes.withColumn("_w", F.element_at(F.array(*[F.lit(w) for w in weights]), place).cast("long"))
             .withColumn("_ratio", F.col("_size") / F.col("_w"))
             # hundredths of words and the weight that are left for this source and the later ones
             .withColumn("_left", F.lit(percent) * F.sum("_size").over(every)
                         - F.lit(100 * max_epochs) * F.coalesce(F.sum("_size").over(before), F.lit(0)))
             .withColumn("_w_left", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
             .withColumn("_full", F.lit(100 * max_epochs) * F.col("_size") * F.col("_w_left")
                         <= F.col("_w") * F.col("_left"))
             .withColumn("_n", F.row_number().over(by_ratio)))
    first_open = F.min(F.when(~F.col("_full"), F.struct("_n", "_left", "_w_left"))).over(every)
    share = share.withColumn("_open", first_open)
    return share.select("_src", "_size", F.when(
        F.col("_full"), (F.lit(max_epochs) * F.col("_size")).cast("double")).otherwise(
        (F.col("_w") * F.col("_open._left")).cast("double") / (F.lit(100) * F.col("_open._w_left")).cast("double"))
        .alias("_target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, max_epochs: int = 2,
                seed: str = "mix-1", payload: list[str] | None = None) -> DataFrame:
    """Per document: id, ``size``, ``source_size``, ``target`` and ``taken`` words (and ``_row`` with ``payload``)."""
    rows = docs.select(
        F.col(id_col).alias("_id"),
        # null sorts after every name
        F.concat(F.when(F.col(source_col).isNull(), "1").otherwise("0"), F.coalesce(F.col(source_col), F.lit(""))).alias("_src"),
        word_count(text_or_empty(text_col)).alias("_n_words"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary")).alias("_key"),
        *([F.struct(*payload).alias("_row")] if payload else []))
    order = ["_src", "_key", "_id", "_n_words"]
    line = stage_sorted(rows, order, "mix")
    parts = stage(line.groupBy("_src", "_pid").agg(F.sum("_n_words").alias("_part")), "mix-parts")
    targets = source_targets(parts.groupBy("_src").agg(F.sum("_part").alias("_size")), weights, percent, max_epochs)
    starts = parts.withColumn("_start", F.coalesce(F.sum("_part").over(
        Window.partitionBy("_src").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    plan = starts.join(targets, "_src").select(
        F.col("_src").alias("_s"), F.col("_pid").alias("_p"), "_start", "_size", "_target",
        F.floor(F.col("_target") + 0.5).cast("long").alias("_budget"))
    inside = Window.partitionBy("_src", "_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = (line.withColumn("_at", F.coalesce(F.sum("_n_words").over(inside), F.lit(0)))
              .join(plan, (F.col("_src") == F.col("_s")) & (F.col("_pid") == F.col("_p"))))
    epochs = F.when(F.col("_size") > 0, F.floor(F.col("_budget") / F.col("_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("_budget") - F.col("_epochs") * F.col("_size")
    part = F.greatest(F.lit(0), F.least(F.col("_n_words"), rest - F.col("_start") - F.col("_at")))
    return placed.withColumn("_epochs", epochs).select(
        F.col("_id").alias(id_col), F.col("_n_words").alias("size"), F.col("_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_epochs") * F.col("_n_words") + part).cast("long").alias("taken"),
        *(["_row"] if payload else []))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **options) -> DataFrame:
    """The mix itself: every document as often as its whole text is taken; the one at the cut of a
    source comes whole if at least half its words are in the budget. Same columns as ``docs``."""
    names = docs.columns
    mix = mix_sources(docs, id_col, text_col, source_col, payload=names, **options)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(F.lit(0)).cast("int")
    return (mix.withColumn("_copies", copies).where("_copies > 0")
            .select(*[F.col("_row").getField(c).alias(c) for c in names],
                    F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_epoch")).drop("_epoch"))
