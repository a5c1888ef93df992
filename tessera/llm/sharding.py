"""Sharding by balanced label propagation (native: DataFrame functions only).

Documents that share a link (by default: equal texts) are neighbours. Every
document starts on a hash shard; the neighbours' shards are counted per link,
and a group wants the shard that most of its members hold. No pair of
neighbours is ever formed: the count per (link, shard) stands for them, and it
is combined before the shuffle, so a link that holds a third of all rows costs
at most one row per shard and map task.

Groups move as a whole and are admitted, the largest first, by prefix counts
against the room that a shard has left: its exact size less the linked rows
already admitted. A refused group asks a shard with room for all of it in the
next round, until every group is admitted or fits no shard. A group larger than
a shard takes as many whole shards as it fills, and its rest stands at the head
of the next. Documents without a neighbour yield: they fill what the groups
leave, by prefix counts. Only groups that fit no shard whole are cut, at the
largest gaps.

Law ``rows``: counts at most one apart.

Defined results: a null text has size 16, checksum 0 and is a neighbour of
empty texts; null and repeated ids are ordinary rows; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stage, stage_sorted, text_or_empty


def _starts(line: DataFrame, *keys: str, rows: str = "1") -> DataFrame:
    """Per partition of a sorted stage (and ``keys``): the sum of ``rows`` in the partitions before, as _p, _start."""
    counts = line.groupBy("_pid", *keys).agg(F.sum(F.expr(rows)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    return counts.select(F.col("_pid").alias("_p"), *keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))


def _lookup(values: list[int], at: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), at)


def admit(wish: DataFrame, room: list[int]) -> DataFrame:
    """(_link, _to): groups (_link, _members, _to) admitted whole to a shard; ``room`` (by shard) shrinks."""
    admitted, step = None, 0
    sizes = wish.select("_link", "_members", "_to", (-F.col("_members")).alias("_first"))
    while True:
        line = stage_sorted(sizes, ["_to", "_first", "_link"], "shard-asked")
        within = Window.partitionBy("_pid", "_to").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
        total = (line.withColumn("_sum", F.sum("_members").over(within))
                 .join(F.broadcast(_starts(line, "_to", rows="_members").withColumnRenamed("_to", "_t")),
                       (F.col("_pid") == F.col("_p")) & (F.col("_to") == F.col("_t"))))
        asked = stage(total.select("_link", "_members", "_first", "_to",
                                   (F.col("_start") + F.col("_sum") <= _lookup(room, F.col("_to"))).alias("_in")), "shard-admitted")
        got = asked.where("_in").select("_link", "_to")
        admitted = got if admitted is None else admitted.unionAll(got)
        for r in asked.where("_in").groupBy("_to").agg(F.sum("_members").alias("_n")).collect():  # a row per shard
            room[r["_to"]] -= r["_n"]
        # those refused ask a shard that has room for all of them
        shards = F.array(*[F.struct(F.lit(i).alias("to"), F.lit(n).cast("long").alias("room")) for i, n in enumerate(room)])
        fit = asked.where("not _in").withColumn("_fit", F.filter(shards, lambda x: x["room"] >= F.col("_members"))).where("size(_fit) > 0")
        coin = F.pmod(F.xxhash64("_link", F.lit(step)), F.size("_fit").cast("long")).cast("int")
        sizes = fit.select("_link", "_members", F.get("_fit", coin)["to"].alias("_to"), "_first")
        step += 1
        if not sizes.limit(1).count():
            return admitted


def propagate(nodes: DataFrame, n_shards: int) -> DataFrame:
    """``nodes`` (with ``_link``) plus ``_members`` and ``_label``, the shard; shards are at most one row apart."""
    n_rows = nodes.count()
    least, larger = divmod(n_rows, n_shards)
    room = [least + (i < larger) for i in range(n_shards)]
    links = stage(nodes.groupBy("_link").agg(F.count(F.lit(1)).alias("_members")).where("_members > 1"), "shard-links")
    # Groups larger than a shard, fewer than there are shards or as many, take shards one after the other.
    large = links.where(F.col("_members") > max(room)).orderBy(F.desc("_members"), "_link").collect()
    segments, at = [], 0  # (shard, rows) in the order in which the line of the others fills them
    for k, group in enumerate(large):
        left, whole = group["_members"], sum(-(-g["_members"] // max(1, least)) for g in large[k:])
        if at < n_shards and room[at] < least and at + 1 + whole <= n_shards:
            at += 1  # a fresh shard, as long as the shards suffice
        while left:
            take = min(left, room[at])
            segments.append((at, take))
            room[at] -= take
            left -= take
            at += bool(left)
    start = F.pmod(F.xxhash64("_link", "_id", F.lit(11)), F.lit(n_shards)).cast("int")
    rows = stage(nodes.join(links, "_link", "left"), "shard-start")
    held = (rows.where(F.col("_members").between(2, least + (larger > 0))).groupBy("_link", start.alias("_to"))
            .agg(F.count(F.lit(1)).alias("_held"), F.first("_members").alias("_members")))
    wish = stage(held.groupBy("_link").agg(F.first("_members").alias("_members"), F.max_by(
        "_to", F.struct("_held", F.xxhash64("_link", "_to"))).alias("_to")), "shard-wish")
    admitted = stage(admit(wish, room), "shard-groups")
    rows = stage(rows.join(admitted.withColumnRenamed("_to", "_label"), "_link", "left"), "shard-labels")
    # The others: the large groups, those that fit no shard whole, then single documents; the largest gaps come first.
    rank = {g["_link"]: i for i, g in enumerate(large)}
    turn = F.when(F.col("_members").isNull(), F.lit(n_shards + 2))
    for link, i in rank.items():
        turn = turn.when(F.col("_link") == link, F.lit(i))
    segments += sorted(((i, n) for i, n in enumerate(room) if n), key=lambda x: (-x[1], x[0]))
    others = rows.where("_label is null").drop("_label").withColumn("_turn", turn.otherwise(F.lit(n_shards + 1)))
    line = stage_sorted(others, ["_turn", "_link", "_id", "_size"], "shard-others")
    ends, total = [], 0
    for _, n in segments:
        total += n
        ends.append(total)
    place = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("_start") + F.col("_pos")))
    label = _lookup([i for i, _ in segments], place) if segments else F.lit(0)
    filled = line.join(F.broadcast(_starts(line)), F.col("_pid") == F.col("_p")).withColumn("_label", label)
    return rows.where("_label is not null").unionByName(filled.select(rows.columns))


def balanced_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = 40) -> DataFrame:
    """Per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``, ``label``."""
    text = text_or_empty(text_col)
    nodes = stage(docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 16).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"), F.xxhash64(text).alias("_link")), "shard-nodes")
    labelled = propagate(nodes, n_shards).select("_id", "_size", "_crc", "_link", "_label")
    # The labels are as large as the shards, so the cuts at equal ranks fall between them.
    line = stage_sorted(labelled, ["_label", "_link", "_id", "_size"], "shard-line")
    starts = _starts(line)
    n_rows = line.count()
    small, larger = n_rows // n_shards, n_rows % n_shards
    rank, cut = F.col("_start") + F.col("_pos"), larger * (small + 1)
    in_larger = F.col("_rank") < cut
    shard = F.when(in_larger, F.floor(F.col("_rank") / (small + 1))).otherwise(
        larger + F.floor((F.col("_rank") - cut) / max(1, small)))
    slot = F.when(in_larger, F.pmod("_rank", F.lit(small + 1))).otherwise(
        F.pmod(F.col("_rank") - cut, F.lit(max(1, small))))
    return (line.join(F.broadcast(starts), F.col("_pid") == F.col("_p")).withColumn("_rank", rank)
            .select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
                    F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), F.col("_label").alias("label")))
