"""Connected components of a link table, by smallest label, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(_node, _label): for each node of ``links`` (_a, _b) the smallest node it can reach.

    A round lowers each node's label to the smallest of its neighbours, hooks
    the node that its label names to the same value, and then takes the label of
    that label, so whole regions fall at once and the rounds don't grow with the
    length of a chain. Rounds end when no label changes: labels only fall, so
    they do end. A hub costs one row per neighbour and the joins read staged
    tables, which AQE can split. Nothing goes through the driver but whether a
    label changed.
    """
    both = links.select(F.col("_a").alias("_node"), F.col("_b").alias("_next")).unionAll(
        links.select(F.col("_b").alias("_node"), F.col("_a").alias("_next"))).distinct()
    both = stage(both, "cc-links")
    labels = stage(both.groupBy("_node").agg(F.min("_next").alias("_m"))
                   .select("_node", F.least("_node", "_m").alias("_label")), "cc-labels")
    while True:
        near = (both.join(labels.select(F.col("_node").alias("_next"), "_label"), "_next")
                .groupBy("_node").agg(F.min("_label").alias("_near")))
        seen = stage(labels.join(near, "_node").select("_node", F.col("_label").alias("_old"), F.least("_label", "_near").alias("_label")),
                     "cc-seen")
        hooks = (seen.where("_label < _old").groupBy(F.col("_old").alias("_root")).agg(F.min("_label").alias("_hook")))
        low = stage(seen.join(hooks, F.col("_node") == F.col("_root"), "left")
                    .select("_node", "_old", F.least("_label", F.coalesce("_hook", "_label")).alias("_label")), "cc-low")
        jump = low.join(low.select(F.col("_node").alias("_n2"), F.col("_label").alias("_far")),
                        F.col("_label") == F.col("_n2"), "left")
        new = stage(jump.select("_node", "_old", F.least("_label", F.coalesce("_far", "_label")).alias("_label")), "cc-labels")
        labels = new.select("_node", "_label")
        if not new.where("_old <> _label").limit(1).count():
            return labels
