"""Phrase collocations from count streams in prefix and suffix order.

Counting. Phrases are counted order by order. A phrase can reach the least
count only if both phrases of one word less do, so the pass for order k emits
only those whose two shorter ones are marked in a bitmap of frequent phrases.
The bitmap has a fixed size (8 MB by default) whatever the corpus; two phrases
that share a bit, and a full bitmap, only let through more, and the counts that
follow are exact. A task cuts its texts into words with vectorised byte
operations, counts each piece of a few MB by dictionary codes and emits distinct
phrases; Spark adds them up before and after the shuffle.

Streams. The frequent phrases of all orders are range-sorted twice: by their
words (prefix order) and by their words read backwards (suffix order). In
prefix order a phrase follows its own beginnings, which a stack of open phrases
holds, so one pass gives each phrase the counts of all its first parts and the
largest count of its extensions to the right; the pass in suffix order gives the
counts of all its last parts and the largest extension to the left. A phrase's
beginnings may lie in earlier partitions: those of each partition's first row
(four at most) are carried into it. No phrase group lies in one task for the
sake of its first word. The two passes are then merge-joined in lockstep.

A candidate inside a longer one of the same count has an extension by one word
of that count, because counts can't rise with length; so the largest one-word
extension decides.

Defined results: null texts count as empty, a null lang as ``und`` (one with
rows of that name); empty tables, and texts without a frequent phrase, give no
row; ids and other columns are not read; repeated rows count again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stage, stage_sorted, text_or_empty
from tessera.llm.textcols import text_slices

_SPACE, _BREAK = 1, 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[[0x20, 0x09]] = _SPACE
_KINDS[list(b".,;:!?\n\v\f\r")] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit hash of a phrase from that of its beginning and that of its last word."""
    h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ word
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _hashes(values) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(v) for v in values), np.uint64, len(values))


class Words:
    """The words of some texts: dictionary codes (with the text's lang), and whether the next word is in the same piece."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, langs: np.ndarray):
        """``data``: bytes of all texts; ``starts``: where each begins; ``langs``: its language code."""
        import pyarrow as pa

        kinds = _KINDS[data]
        word, broken = kinds == 0, kinds == _BREAK
        new_text = np.zeros(len(data) + 1, bool)
        new_text[starts] = True
        edge = np.concatenate([[True], ~word]) if len(data) else np.ones(1, bool)
        begins = np.flatnonzero(word & (edge[:-1] | new_text[:-1]))
        after = np.concatenate([~word[1:], [True]]) if len(data) else np.empty(0, bool)
        ends = np.flatnonzero(word & (after | new_text[1:])) + 1
        piece = np.cumsum(broken | new_text[:-1], dtype=np.int64)[begins]
        offsets = np.concatenate([[0], np.cumsum(ends - begins)])
        letters = _LOWER[data[word]]
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)])
        encoded = column.dictionary_encode()
        self.words = encoded.dictionary
        codes = encoded.indices.to_numpy().astype(np.int64)
        self.lang = langs[np.searchsorted(starts, begins, "right") - 1] if len(begins) else np.empty(0, np.int64)
        self.codes, self.n_words = codes, len(self.words)
        self.together = np.append(piece[1:] == piece[:-1], False) if len(piece) else np.empty(0, bool)

    def hashes(self, lang_hash: np.ndarray, order: int) -> np.ndarray:
        """Hash of the phrase of ``order`` words at each place (meaningless where it leaves its piece)."""
        if not len(self.codes):
            return np.empty(0, np.uint64)
        word = _hashes(self.words.to_pylist())[self.codes]
        h = _mixed(lang_hash[self.lang], word)
        for j in range(1, order):
            h = _mixed(h, np.append(word[j:], np.zeros(j, np.uint64))[:len(word)])
        return h

    def whole(self, order: int) -> np.ndarray:
        """Whether the phrase of ``order`` words at each place lies in one piece."""
        ok = np.ones(len(self.codes), bool)
        for j in range(order - 1):
            ok &= np.append(self.together[j:], np.zeros(j, bool))[:len(ok)]
        return ok

    def counted(self, at: np.ndarray, order: int):
        """Distinct phrases of ``order`` words at the places ``at``: a place of each, and how often they occur."""
        ids = self.lang[at]
        for j in range(order):
            _, ids = np.unique(ids * self.n_words + self.codes[at + j], return_inverse=True)
        _, first, n = np.unique(ids, return_index=True, return_counts=True)
        return at[first], n

    def phrases(self, at: np.ndarray, order: int):
        import pyarrow as pa
        import pyarrow.compute as pc

        parts = [self.words.take(pa.array(self.codes[at + j])) for j in range(order)]
        return parts[0] if order == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))


def _portions(data: np.ndarray, starts: np.ndarray, most: int):
    """Cut long data at text starts and piece ends, so that no phrase is cut and memory stays small."""
    if len(data) <= most:
        yield 0, len(data)
        return
    cuts = np.union1d(starts, np.flatnonzero(_KINDS[data] == _BREAK))
    at = 0
    while at < len(data):
        i = np.searchsorted(cuts, at + most, "right") - 1
        to = int(cuts[i]) if i >= 0 and cuts[i] > at else (int(cuts[i + 1]) if i + 1 < len(cuts) else len(data))
        if to <= at:
            to = len(data)
        if len(data) - at <= most:
            to = len(data)
        yield at, to
        at = to


def _count_task(order: int, marks, max_bytes: int):
    """Distinct phrases of one order with their counts, portion by portion; for order 1 also all words of a lang (null phrase)."""
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("lang", pa.large_string()), ("phrase", pa.large_string()), ("n", pa.int64())])
        bits = np.frombuffer(marks.value, np.uint8) if order > 1 else None
        for part, texts in text_slices(batches, "text", max_bytes):
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
            starts = offsets[:-1] - offsets[0]
            encoded = part.column("lang").dictionary_encode()
            langs, lang_code = encoded.dictionary.cast(pa.large_string()), encoded.indices.to_numpy().astype(np.int64)
            lang_hash = _hashes([x.encode() for x in langs.to_pylist()])
            held = np.diff(offsets) > 0
            starts, lang_code = starts[held], lang_code[held]
            for lo, hi in _portions(data, starts, max_bytes):
                first = max(np.searchsorted(starts, lo, "right") - 1, 0)
                last = np.searchsorted(starts, hi, "left")
                if hi == lo:
                    continue
                words = Words(data[lo:hi], np.maximum(starts[first:last] - lo, 0), lang_code[first:last])
                whole = words.whole(order)
                if order > 1:
                    h = words.hashes(lang_hash, order - 1) & np.uint64(8 * len(bits) - 1)
                    marked = (bits[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    whole &= marked & np.append(marked[1:], False)
                at, n = words.counted(np.flatnonzero(whole), order)
                if len(at):
                    yield pa.RecordBatch.from_arrays([langs.take(pa.array(words.lang[at])), words.phrases(at, order).view(pa.large_string()),
                                                      pa.array(n.astype(np.int64))], schema=schema)
                if order == 1 and len(words.codes):
                    total = np.bincount(words.lang, minlength=len(langs))
                    yield pa.RecordBatch.from_arrays([langs, pa.nulls(len(langs), pa.large_string()), pa.array(total.astype(np.int64))], schema=schema)
    return run


def _mark_task(order: int, n_bits: int):
    """Places of the phrases in the bitmap: its 64-bit words, each with the bits that some phrases set."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            h = _hashes([x.encode() for x in langs.dictionary.to_pylist()])[langs.indices.to_numpy()] if batch.num_rows else np.empty(0, np.uint64)
            split = [x.encode().split(b" ") for x in batch.column("phrase").to_pylist()]
            for j in range(order):
                h = _mixed(h, _hashes([w[j] for w in split]))
            h &= np.uint64(n_bits - 1)
            bit = np.left_shift(np.uint64(1), h & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((h >> np.uint64(6)).astype(np.int32)), pa.array(bit.view(np.int64))], ["at", "bits"])
    return run


def bitmap(frequent: DataFrame, order: int, n_bits: int):
    """Broadcast variable: a bitmap of fixed size with a bit for each phrase (``n_bits / 8`` bytes, whatever the table)."""
    words = frequent.select("lang", "phrase").mapInArrow(_mark_task(order, n_bits), "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    rows = words.toArrow()  # n_bits / 64 rows at most
    out = np.zeros(n_bits // 64, np.int64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return frequent.sparkSession.sparkContext.broadcast(out.tobytes())


def frequent_phrases(docs: DataFrame, max_words: int, min_count: int, n_bits: int, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(``lang, phrase, f, k`` of the phrases with f >= min_count; ``lang, n``): exact counts over all texts."""
    texts = docs.select(text_or_empty().alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    found, total, marks = None, None, None
    for k in range(1, max_words + 1):
        counts = (texts.mapInArrow(_count_task(k, marks, max_bytes), "lang string, phrase string, n long")
                  .groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
                  .where((F.col("f") >= min_count) | F.col("phrase").isNull()))
        counts = stage(counts, f"phrases-{k}")
        if k == 1:
            total = counts.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
            counts = counts.where(F.col("phrase").isNotNull())
        counts = counts.withColumn("k", F.lit(k))
        found = counts if found is None else found.unionByName(counts)
        if k == max_words or counts.isEmpty():
            return found, total
        if marks is not None:
            marks.unpersist()
        marks = bitmap(counts, k, n_bits)


def _stream_task(batches):
    """One pass over phrases in order: counts of each phrase's beginnings, largest count of its extensions by one word."""
    import pyarrow as pa

    schema = pa.schema([("lang", pa.string()), ("w", pa.list_(pa.string())), ("f", pa.int64()), ("heads", pa.list_(pa.int64())),
                        ("extended", pa.int64()), ("carried", pa.bool_())])
    open_, place, done = [], None, []  # an open phrase: [lang, words, count, counts of its beginnings, largest extension, carried]

    def flush():
        rows = list(zip(*done))
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    for batch in batches:
        for pid, lang, w, f, carried in zip(*(batch.column(c).to_pylist() for c in ("_pid", "lang", "w", "f", "carried"))):
            while open_ and (place != pid or open_[-1][0] != lang or open_[-1][1] != w[:len(open_[-1][1])]):
                done.append(open_.pop())
            place = pid
            if open_ and len(open_[-1][1]) == len(w) - 1:
                open_[-1][4] = max(open_[-1][4], f)
            open_.append([lang, w, f, [x[2] for x in open_], 0, carried])
        if len(done) > 10000:
            yield flush()
    done.extend(reversed(open_))
    if done:
        yield flush()


def count_stream(frequent: DataFrame, words: Column, name: str) -> DataFrame:
    """``lang, w, f, heads, extended`` in the order of ``words``: heads[i] is the count of the first i + 1 words
    (the phrase itself left out), ``extended`` the largest count of the phrase with one word more at its end."""
    spark = frequent.sparkSession
    rows = stage_sorted(frequent.select("lang", words.alias("w"), "f"), ["lang", "w"], name)
    # what each partition's first phrase begins with: max_words - 1 phrases a partition at most
    first = rows.where("_pos = 0 AND size(w) > 1").select("_pid", "lang", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - 1), lambda j: F.slice("w", 1, j))).alias("w"))
    carried = F.broadcast(first).join(rows.select("lang", "w", "f"), ["lang", "w"]).select(
        "_pid", "lang", "w", "f", F.lit(True).alias("carried"))
    stream = rows.select("_pid", "lang", "w", "f", F.lit(False).alias("carried")).unionByName(carried)
    passed = stage(stream.repartition(partitions(spark), "_pid").sortWithinPartitions("_pid", "lang", "w").mapInArrow(
        _stream_task, "lang string, w array<string>, f long, heads array<long>, extended long, carried boolean"), name + "-passed")
    later = passed.where("carried").groupBy("lang", "w").agg(F.max("extended").alias("later"))  # rows as few as those carried
    return passed.where("NOT carried").join(F.broadcast(later), ["lang", "w"], "left").select(
        "lang", "w", "f", "heads", F.greatest("extended", F.coalesce("later", F.lit(0))).alias("extended"))


def collocations(docs: DataFrame, max_words: int = 5, min_count: int = 100, per_lang: int = 2000,
                 n_bits: int = 1 << 26, max_bytes: int = 4 << 20) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases by the score of their weakest cut.

    a, l, r: counts of the phrase and of the two parts of that cut; n: all
    words of the language. ``n_bits`` (a power of two) is the size of the
    bitmap: it bounds memory, not results.
    """
    found, total = frequent_phrases(docs, max_words, min_count, n_bits, max_bytes)
    words = F.split("phrase", " ")
    forward = count_stream(found, words, "phrases-prefix")
    backward = count_stream(found, F.reverse(words), "phrases-suffix")
    longer = F.size("w") > 1
    left = forward.where(longer).select("lang", F.array_join("w", " ").alias("phrase"), F.col("f").alias("a"),
                                        F.col("heads").alias("_first"), F.col("extended").alias("_right"))
    right = backward.where(longer).select("lang", F.array_join(F.reverse("w"), " ").alias("phrase"),
                                          F.col("heads").alias("_last"), F.col("extended").alias("_left"))
    merged = left.hint("merge").join(right, ["lang", "phrase"]).where("_right < a AND _left < a").join(total, "lang")
    wide = "decimal(38,0)"
    cut = f"""transform(sequence(1, size(_first)), j -> struct(
        (cast(1000 as {wide}) * a * n) div (cast(get(_first, j - 1) as {wide}) * get(_last, size(_last) - j)) AS score,
        j AS cut, get(_first, j - 1) AS l, get(_last, size(_last) - j) AS r))"""
    scored = merged.withColumn("_cut", F.array_min(F.expr(cut))).select(
        "lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
