"""MinHash near-dedup by a multi-index Hamming join.

A document is the set of its distinct 5-word shingles (64-bit hashes; fewer
words: the whole sequence as one). Equal sets become one class. A class has a
MinHash signature; its first 48 slots of 16 bits are cut into 12 chunks of 4.
Signatures that differ in at most 23 slots have, by the pigeonhole principle, a
chunk with at most one difference, so 48 keys (chunk, the slot left out, the
other three values) bring every such pair together in a bucket.

Buckets are never expanded into all their pairs:

1. Star: each bucket's pivot is its most popular class (members of its
   buckets, summed); every member is confirmed against the pivot only. A group
   of near copies falls together here, with one row per member.
2. Rest: in buckets that still hold several components, members of different
   components are compared by signature inside a task, in numpy, in blocks of
   bounded size; a pair leaves the task once (in its first common bucket), and
   only if set sizes, 256 slots (6 standard deviations below the threshold: of
   the links at the threshold less than 1 in 10 million fails this test) and a
   bitmap of the shingles (a strict bound) allow the similarity.

Links are confirmed on the full shingle sets (rows of a pivot are spread over
blocks of partners), components come from Spark joins.

Defined results: null, empty and blank texts have the empty set and link with
nothing; rows with a null id are kept, with a null component, and link with
nothing; rows that share an id are one document, linked by any of its texts;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stage
from tessera.llm.components import components
from tessera.llm.textcols import codes_of, owners, ragged, text_slices

WIDTH = 5          # words of a shingle
CHUNKS, SLOTS = 12, 4
INDEX = CHUNKS * SLOTS
ALL_SLOTS = 256
BITMAP_BITS = 2048
SLOT_BYTES = 2 * INDEX + ALL_SLOTS - INDEX
SIGNATURE_BYTES = SLOT_BYTES + BITMAP_BITS // 8
_RNG = np.random.RandomState(20240501)
_PLACE = _RNG.randint(0, 1 << 62, WIDTH + 1, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _RNG.randint(0, 1 << 31, ALL_SLOTS, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.randint(0, 1 << 32, ALL_SLOTS, dtype=np.int64).astype(np.uint32)


def _mix(h: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts):
    """For each text of a large_string array its sorted distinct shingle hashes (uint64)."""
    import xxhash

    flat, at = ragged(pc.ascii_split_whitespace(texts))
    code, words = codes_of(flat)
    words = pc.ascii_lower(words).to_pylist()  # lower-cased once per distinct word
    real = np.array([bool(w) for w in words], bool)
    hashes = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    keep = real[code] if len(code) else np.zeros(0, bool)
    n_words = np.bincount(owners(at)[keep], minlength=len(texts))
    h = hashes[code[keep]] if len(code) else np.zeros(0, np.uint64)
    rolled = np.zeros(len(h), np.uint64)
    for j in range(WIDTH):
        rolled[:len(h) - j if j else None] += h[j:] * _PLACE[j]
    rolled = _mix(rolled)
    start = 0
    for n in n_words.tolist():
        if n >= WIDTH:
            yield np.unique(rolled[start:start + n - WIDTH + 1])
        elif n:
            yield _mix((h[start:start + n] * _PLACE[:n]).sum(keepdims=True) + np.full(1, n, np.uint64) * _PLACE[WIDTH])
        else:
            yield np.zeros(0, np.uint64)
        start += n


def signature(shingles: np.ndarray) -> bytes:
    """48 slots of 16 bits, 208 slots of 8 bits, and a bitmap of the shingles."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(ALL_SLOTS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        least = np.minimum(least, (x[None, i:i + 2048] * _MUL[:, None] + _ADD[:, None]).min(axis=1))
    slots = ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
    bits = np.zeros(BITMAP_BITS, np.uint8)
    bits[(shingles % np.uint64(BITMAP_BITS)).astype(np.int64)] = 1
    return (slots[:INDEX].astype("<u2").tobytes() + (slots[INDEX:] >> np.uint16(8)).astype(np.uint8).tobytes()
            + np.packbits(bits).tobytes())


def _signed(batches):
    for part, texts in text_slices(batches):
        sizes, digests, signatures = [], [], []
        for s in shingle_sets(texts):
            sizes.append(len(s))
            digests.append(hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=16).digest() if len(s) else None)
            signatures.append(signature(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [part.column("_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
            names=["_id", "_n", "_digest", "_sig"])


def _index_keys(batches):
    """48 keys of each class: chunk and left-out slot in the top bits, then the three values."""
    for batch in batches:
        n = batch.num_rows
        slots = np.frombuffer(b"".join(batch.column("_sig").to_pylist()), np.uint8).reshape(n, SIGNATURE_BYTES)
        slots = np.ascontiguousarray(slots[:, :2 * INDEX]).view("<u2").astype(np.int64).reshape(n, CHUNKS, SLOTS)
        keys = np.empty((n, CHUNKS, SLOTS), np.int64)
        for out in range(SLOTS):
            a, b, c = (slots[:, :, i] for i in range(SLOTS) if i != out)
            keys[:, :, out] = (np.arange(CHUNKS) * SLOTS + out << 48) | a << 32 | b << 16 | c
        ids = np.repeat(batch.column("_rep").to_numpy(zero_copy_only=False).astype(np.int64), INDEX)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["_key", "_rep"])


def _similar_pairs(percent: int):
    """Pairs of one bucket (block) from different components that may be similar enough."""
    share = percent / 100
    least = ALL_SLOTS * share - 6 * (ALL_SLOTS * share * (1 - share)) ** 0.5

    def pairs(key, block_a, block_b, rows):
        rep, comp, size, block, sig = rows
        wide = np.ascontiguousarray(sig[:, :2 * INDEX]).view("<u2")
        rest = sig[:, 2 * INDEX:SLOT_BYTES]
        bits = np.ascontiguousarray(sig[:, SLOT_BYTES:]).view(np.uint64)
        first = np.flatnonzero(block == block_a)
        second = first if block_a == block_b else np.flatnonzero(block == block_b)
        chunk, out = divmod(int(key) >> 48, SLOTS)
        for i in first.tolist():
            other = second[second > i] if block_a == block_b else second
            other = other[(comp[other] != comp[i]) & (rep[other] != rep[i])
                          & (100 * np.minimum(size[other], size[i]) >= percent * np.maximum(size[other], size[i]))]
            if not len(other):
                continue
            same = wide[other] == wide[i]
            enough = same.sum(axis=1) + (rest[other] == rest[i]).sum(axis=1) >= least
            # a bit that only one side has stands for at least one shingle that the other lacks
            own = np.bitwise_count(bits[i] & ~bits[other]).sum(axis=1, dtype=np.int64)
            theirs = np.bitwise_count(bits[other] & ~bits[i]).sum(axis=1, dtype=np.int64)
            most = np.minimum(size[i] - own, size[other] - theirs)
            enough &= 100 * most >= percent * (size[i] + size[other] - most)
            other, same = other[enough], same[enough].reshape(-1, CHUNKS, SLOTS)
            if not len(other):
                continue
            agree = same.sum(axis=2)
            met = (agree >= SLOTS - 1).argmax(axis=1)  # the first bucket that the two share
            row = np.arange(len(other))
            left_out = np.where(agree[row, met] == SLOTS, 0, (~same[row, met]).argmax(axis=1))
            for j in other[(met == chunk) & (left_out == out)].tolist():
                yield int(rep[i]), int(rep[j])

    def run(batches):
        names = ("_key", "_block_a", "_block_b")
        held, at = [], None

        def flush():
            rows = [np.concatenate([h[i] for h in held]) for i in range(5)]
            got = list(pairs(*at, rows))
            return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.int64()) for i in (0, 1)], names=["_a", "_b"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], axis=1)
            cols = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_rep", "_comp", "_n", "_block")]
            sig = np.frombuffer(b"".join(batch.column("_sig").to_pylist()), np.uint8).reshape(-1, SIGNATURE_BYTES)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if lo == hi:
                    continue
                key = tuple(keys[lo].tolist())
                if key != at and held:
                    yield flush()
                    held = []
                at = key
                held.append([c[lo:hi] for c in cols] + [sig[lo:hi]])
        if held:
            yield flush()
    return run


def _sets(batches):
    for part, texts in text_slices(batches):
        yield pa.RecordBatch.from_arrays(
            [part.column("_id"), pa.array([s.astype("<u8").tobytes() for s in shingle_sets(texts)], pa.binary())],
            names=["_id", "_set"])


def _confirm(percent: int):
    """Rows sorted by (_a, _salt, _b): the sets of _a (no _b) come first, then its partners'."""
    def run(batches):
        at, own = None, []
        for batch in batches:
            a, salt = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_a", "_salt"))
            out: tuple[list, list] = ([], [])
            for i, (b, blob) in enumerate(zip(batch.column("_b").to_pylist(), batch.column("_set"))):
                if (a[i], salt[i]) != at:
                    at, own = (a[i], salt[i]), []
                values = np.frombuffer(blob.as_buffer(), "<u8")
                if b is None:
                    own.append(values.copy())
                    continue
                for mine in own:
                    place = np.searchsorted(mine, values)
                    both = int((mine[np.minimum(place, len(mine) - 1)] == values).sum())
                    if 100 * both >= percent * (len(mine) + len(values) - both):
                        out[0].append(a[i])
                        out[1].append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["_a", "_b"])
    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, block: int = 64) -> DataFrame:
    """The pairs (_a, _b) whose full sets are similar enough; a set of _a goes to a task with at most ``block`` partners on average."""
    degree = stage(pairs.groupBy("_a").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_salts")), "mh-degree")
    partners = (pairs.join(degree, "_a").withColumn("_salt", F.pmod(F.xxhash64("_b"), F.col("_salts")).cast("int"))
                .join(sets.withColumnRenamed("_id", "_b"), "_b").select("_a", "_salt", "_b", "_set"))
    hubs = (degree.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
            .join(sets.withColumnRenamed("_id", "_a"), "_a").select("_a", "_salt", F.lit(None).cast("long").alias("_b"), "_set"))
    n = partitions(pairs.sparkSession)
    both = hubs.unionAll(partners).repartition(n, "_a", "_salt").sortWithinPartitions("_a", "_salt", F.col("_b").asc_nulls_first())
    return both.mapInArrow(_confirm(percent), "_a long, _b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                    block: int = 1024) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id reachable), ``kept``."""
    base = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
    rows = stage(base.mapInArrow(_signed, "_id long, _n long, _digest binary, _sig binary"), "mh-rows")
    linkable = rows.where("_n > 0 and _id is not null")
    classes = stage(linkable.groupBy("_digest").agg(
        F.min("_id").alias("_rep"), F.first("_n").alias("_n"), F.first("_sig").alias("_sig")), "mh-classes")

    # buckets of two or more classes
    keys = stage(classes.select("_rep", "_sig").mapInArrow(_index_keys, "_key long, _rep long"), "mh-keys")
    shared = stage(keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_members")).where("_members > 1"), "mh-buckets")
    met = stage(keys.join(shared, "_key"), "mh-met")

    # the star of each bucket
    popular = stage(met.groupBy("_rep").agg(F.sum("_members").alias("_weight")), "mh-popular")
    pivots = stage(met.join(popular, "_rep").groupBy("_key").agg(
        F.max_by("_rep", F.struct("_weight", -F.col("_rep"))).alias("_pivot")), "mh-pivots")
    star = stage(met.join(pivots, "_key").where("_rep <> _pivot")
                 .select(F.col("_pivot").alias("_a"), F.col("_rep").alias("_b")).distinct(), "mh-star")
    sets = stage(base.where("_id is not null").join(popular.select(F.col("_rep").alias("_id")), "_id")
                 .select("_id", "text").mapInArrow(_sets, "_id long, _set binary").where("octet_length(_set) > 0"), "mh-sets")
    sizes = stage(classes.groupBy("_rep").agg(F.max("_n").alias("_max"), F.min("_n").alias("_min")), "mh-sizes")
    near = (star.join(sizes.toDF("_a", "_max_a", "_min_a"), "_a").join(sizes.toDF("_b", "_max_b", "_min_b"), "_b")
            .where(f"100 * _max_a >= {percent} * _min_b and 100 * _max_b >= {percent} * _min_a").select("_a", "_b"))
    links = stage(confirmed(near, sets, percent), "mh-links")
    labels = components(links)

    # what the stars left apart
    known = met.join(labels.withColumnRenamed("_node", "_rep"), "_rep", "left").withColumn(
        "_comp", F.coalesce("_label", "_rep")).select("_key", "_rep", "_members", "_comp")
    known = stage(known, "mh-known")
    # In a large bucket the members of its main component needn't meet each other, only the others.
    of_comp = known.groupBy("_key", "_comp").agg(F.count(F.lit(1)).alias("_of_comp"))
    n_rest = F.sum("_of_comp") - F.max("_of_comp")
    mixed = stage(of_comp.groupBy("_key").agg(
        F.max_by("_comp", F.struct("_of_comp", "_comp")).alias("_main"),
        F.ceil(F.max("_of_comp") / block).cast("int").alias("_main_blocks"),
        F.ceil(n_rest / block).cast("int").alias("_rest_blocks"), F.sum("_of_comp").alias("_all"),
        F.count(F.lit(1)).alias("_comps")).where("_comps > 1").drop("_comps"), "mh-mixed")
    small, is_main = F.col("_all") <= block, F.col("_comp") == F.col("_main")
    coin = F.xxhash64("_rep")
    own = (F.when(small, F.lit(0)).when(is_main, F.col("_rest_blocks") + F.pmod(coin, F.col("_main_blocks")))
           .otherwise(F.pmod(coin, F.col("_rest_blocks"))).cast("int"))
    others = F.when(small, F.lit(1)).when(is_main, F.col("_rest_blocks")).otherwise(
        F.col("_rest_blocks") + F.col("_main_blocks"))
    rest = (known.join(mixed, "_key").withColumn("_block", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), others - 1)))
            .select("_key", F.least("_block", "_other").alias("_block_a"), F.greatest("_block", "_other").alias("_block_b"),
                    "_block", "_rep", "_comp")
            .join(classes.select("_rep", "_n", "_sig"), "_rep"))
    order = ["_key", "_block_a", "_block_b"]
    pairs = stage(rest.repartition(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
                  .select(*order, "_block", "_rep", "_comp", "_n", "_sig")
                  .mapInArrow(_similar_pairs(percent), "_a long, _b long"), "mh-pairs")
    more = confirmed(pairs, sets, percent)

    # rows that share an id are one document: unite the classes it is in
    in_class = stage(linkable.select("_id", "_digest").join(classes.select("_digest", "_rep"), "_digest")
                     .select("_id", "_digest", "_rep"), "mh-in-class")
    same_id = (in_class.groupBy("_id").agg(F.min("_rep").alias("_a"), F.max("_rep").alias("_b"))
               .where("_a <> _b").select("_a", "_b"))
    united = components(stage(labels.where("_node <> _label").toDF("_a", "_b").unionAll(more).unionAll(same_id), "mh-all-links"))
    of_row = in_class.select("_digest", "_rep").distinct().join(
        united.withColumnRenamed("_node", "_rep"), "_rep", "left").select(
        F.col("_digest").alias("_d"), F.coalesce("_label", "_rep").alias("_component"))
    out = rows.select("_id", "_n", "_digest").join(
        of_row, (F.col("_digest") == F.col("_d")) & F.col("_id").isNotNull(), "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("_component", "_id"))
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """``docs`` with one document of each group (the smallest id), same columns."""
    gone_id = "_gone"
    while gone_id in docs.columns:
        gone_id += "_"
    gone = near_duplicates(docs, id_col, text_col, percent).where("not kept").select(F.col(id_col).alias(gone_id)).distinct()
    return docs.join(gone, F.col(id_col).cast("long") == F.col(gone_id), "left_anti")
