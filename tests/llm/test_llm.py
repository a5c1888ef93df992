"""Training-data operators against brute force, exact round trips and held-out labels."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import oracles, queries
from tessera.llm.ann import nearest
from tessera.llm.components import components
from tessera.llm.exact_dedup import drop_copies, exact_dedup, mark_copies
from tessera.llm.line_dedup import line_dedup
from tessera.llm.minhash_dedup import drop_near_duplicates, near_duplicates, shingle_sets
from tessera.llm.mixing import mix_sources, mixed_documents
from tessera.llm.piece_codec import encode_documents, encode_text
from tessera.llm.quality import FEATURES, good_documents, grow, quality, statistics
from tessera.llm.sharding import balanced_shards
from tessera.llm.spm import CHUNK, Model, Normalizer
from tessera.llm.token_counts import Transducer, block_map, compose, count_tokens, total_of, total_of_blocks
from tessera.llm import toxicity as toxicity_module
from tessera.llm.toxicity import toxicity
from tessera.session import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, size int, kept string, _row int"
WORDS = "the of and a in to was is for on that with as by at from it an be this which or are".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def odd_rows():
    """Nulls, empty and very long texts, repeated rows and ids, ties, copies of two kinds."""
    rng = random.Random(5)
    base, other = prose(rng, 120), prose(rng, 60)
    shared = "A shared line that is long enough to be a key, É too"
    texts = [None, "", "", " \t", "one", "One", base, base, base + " end", base.replace("the", "thy", 1), other,
             prose(rng, 20000), "x" * 70000, "a\n\n b \n", "two words", "two words"]
    texts += [f"{shared.upper() if i % 2 else shared}  \nown line of document number {i} that is quite long\n{shared}" for i in range(7)]
    rows = [(i, t, None, None if i % 5 == 0 else f"src{i % 3}", None, "x", 1, None, i) for i, t in enumerate(texts)]
    rows += [rows[6], (None, base, "en", "src1", 1, None, None, "k", 2), (None, None, None, None, None, None, None, None, None),
             (3, other + " more", "en", "src0", 1, None, None, None, 4)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(20)] + [(None, 1, 1), (4, None, None), (5, 0, 1), (5, 1, 0)],
                                 "doc_id long, quality int, toxic int")


def model_path():
    return queries.tokenizer_path()


@pytest.mark.parametrize("name", sorted(oracles.ORACLE))
def test_matches_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf).toPandas()
    want = con.execute(oracles.ORACLE[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda d: sorted(map(tuple, d[cols].astype(str).values.tolist()))
    assert rows(got) == rows(want)


def test_exact_dedup(spark, odd, empty):
    groups = collections.defaultdict(list)
    for r in odd_rows():
        groups[r[1] or ""].append(r[0])
    best = lambda ids: max((i for i in ids if i is not None), default=None)
    got = exact_dedup(odd).collect()
    assert len(got) == len(odd_rows())
    for text, ids in groups.items():
        rows = [r for r in got if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, ids))
        assert {(r.keep_id, r.group_size) for r in rows} == {(best(ids), len(ids))}
        assert [r.doc_id for r in rows if r.kept] == [best(ids)]
    kept = drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert exact_dedup(empty).count() == drop_copies(empty).count() == 0


def test_exact_dedup_hot_text(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("t"), F.floor(F.col("id") / 9).cast("string"))).alias("text"))
    got = exact_dedup(rows)
    hot = got.where(F.col("keep_id") % 3 == 0)
    assert [tuple(r) for r in hot.select("keep_id", "group_size").distinct().collect()] == [(5997, 2000)]
    assert got.where("kept").count() == got.select("text_sha256").distinct().count()
    assert drop_copies(rows, keep="min").where("text = 'hot'").first().doc_id == 0


@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_dedup_spreads_equal_ids(spark, keep):
    """Half of the rows are one text, with null ids or a single one: the sub-ranges share them evenly, one row stays."""
    for hot_id in (F.lit(None).cast("long"), F.lit(77).cast("long")):
        rows = spark.range(20000).select(F.when(F.col("id") % 2 == 0, hot_id).otherwise(F.col("id")).alias("doc_id"),
                                         F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
        marked = mark_copies(rows, keep=keep)
        assert marked.where("_kept").count() == 10001
        hot = marked.where("_size > 1")
        assert hot.count() == 10000 and hot.where("_kept").count() == 1
        assert {r._keep for r in hot.select("_keep").distinct().collect()} == {rows.where("text = 'hot'").first().doc_id}
    salts = spark.read.parquet(marked.inputFiles()[0].rsplit("/", 1)[0]).where("_is_hot").groupBy("_salt").count().collect()
    assert len(salts) == 64 and max(r["count"] for r in salts) < 3 * min(r["count"] for r in salts)


def test_line_dedup(spark, odd, empty):
    docs = odd_rows()
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))
    held = collections.defaultdict(set)
    for r in docs:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 40:
                held[key(line)].add(r[0])
    last = {k: max(i for i in v if i is not None) for k, v in held.items() if len(v) >= 5}
    want = collections.Counter()
    for r in docs:
        lines = (r[1] or "").split("\n")
        drop = [key(x) in last and last[key(x)] != r[0] for x in lines]
        bits = "".join(map(str, map(int, drop)))
        bits += "0" * (-len(bits) % 8)
        packed = bytes(int(bits[i:i + 8], 2) for i in range(0, len(bits), 8)).rstrip(b"\0")
        want[r[0], len(lines), sum(drop), packed, "\n".join(x for x, d in zip(lines, drop) if not d)] += 1
    assert sum(x[2] for x in want) > 5
    assert collections.Counter((r[0], r[1], r[2], bytes(r[3]), r[4]) for r in line_dedup(odd).collect()) == want
    assert line_dedup(empty).count() == 0


def test_mixing(spark, odd, empty):
    got = mix_sources(odd).collect()
    sizes = collections.Counter()
    for r in odd_rows():
        sizes["1" if r[3] is None else "0" + r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    weight = dict(zip(sorted(sizes), [5, 2, 1] * 9))
    target, open_ = {s: 0.0 for s in sizes}, set(sizes)
    left = 1.5 * sum(sizes.values())
    while open_:  # rounds of resharing, as the contract puts it
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    by_size = {sizes[s]: target[s] for s in sizes}
    taken = collections.Counter()
    for r in got:
        assert math.isclose(r.target, by_size[r.source_size]) and 0 <= r.taken <= 2 * r.size
        taken[r.source_size] += r.taken
    assert len(got) == len(odd_rows()) and all(abs(taken[n] - t) <= 0.5 for n, t in by_size.items())
    again = mix_sources(odd.repartition(7))
    assert sorted(map(str, again.collect())) == sorted(map(str, got))
    mixed = mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() > 0
    assert mix_sources(empty).count() == mixed_documents(empty).count() == 0


def test_sharding(spark, odd, empty):
    got = balanced_shards(odd, n_shards=4).collect()
    assert len(got) == len(odd_rows())
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(4)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in odd_rows())
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert balanced_shards(empty).count() == 0
    few = balanced_shards(odd.limit(2), n_shards=40).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0)]


def test_sharding_keeps_groups_together(spark):
    rows = spark.range(8000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, F.floor(F.col("id") / 24))
                                    .otherwise(F.col("id") + 100000).cast("string").alias("text"))
    got = balanced_shards(rows, n_shards=10)
    groups = got.groupBy("text_crc32").agg(F.count("*").alias("n"), F.count_distinct("shard").alias("s")).where("n > 1")
    assert groups.where("s > 1").count() <= 9  # one at each cut at most
    sizes = {r["count"] for r in got.groupBy("shard").count().collect()}
    assert sizes == {800}


@pytest.mark.parametrize("groups", [[2000], [250, 2000, 7500], [1000, 1500, 3000] * 3, [2600, 2600, 2600]])
def test_sharding_keeps_large_groups_together(spark, groups):
    n, size = 100000, 2500  # 40 shards
    texts = F.concat(F.lit("single "), F.col("id").cast("string"))
    at = 0
    for i, g in enumerate(groups):
        texts = F.when((F.col("id") >= at) & (F.col("id") < at + g), F.lit(f"group {i}")).otherwise(texts)
        at += g
    got = balanced_shards(spark.range(n).select(F.col("id").alias("doc_id"), texts.alias("text")), n_shards=40)
    assert {r["count"] for r in got.groupBy("shard").count().collect()} == {size}
    crc = {zlib.crc32(f"group {i}".encode()): g for i, g in enumerate(groups)}
    held = got.where(F.col("text_crc32").isin(list(crc))).groupBy("text_crc32").agg(
        F.count("*").alias("n"), F.count_distinct("shard").alias("s")).collect()
    assert sorted((r.n, r.s) for r in held) == sorted((g, -(-g // size)) for g in groups)


def brute_components(rows):
    sets = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, frozenset(tuple(words[j:j + 5]) for j in range(max(1, len(words) - 4))) if words else frozenset()))
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}, sets


def near_copies(n, groups, seed):
    """Groups of texts, each made from an earlier text of its group by a few replaced words."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        texts = [prose(rng, rng.choice([3, 8, 40, 120]))]
        for _ in range(n // groups - 1):
            words = rng.choice(texts).split()
            for _ in range(rng.randint(0, max(1, len(words) // 30))):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
            texts.append(" ".join(words).upper() if rng.random() < 0.2 else " ".join(words))
        rows += texts
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, t) for i, t in zip(order, rows)]


@pytest.mark.parametrize("block", [4, 1024])
def test_near_duplicates(spark, block):
    rows = near_copies(300, 12, block)
    want, sets = brute_components(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_odd_rows(spark, odd, empty):
    rows = [(r[0], r[1]) for r in odd_rows()]
    want, sets = brute_components(rows)
    got = near_duplicates(odd).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {*want.items(), (None, None)}
    assert collections.Counter((r.doc_id, r.n_shingles) for r in got) == collections.Counter((i, len(s)) for i, s in sets)
    assert all(r.kept for r in got if r.doc_id is None)
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.where("doc_id is null").count() == 2
    assert near_duplicates(empty).count() == drop_near_duplicates(empty).count() == 0


def test_shingles_of_sliced_arrays():
    texts = ["É a b", "one TWO three four five six", "", "one two three four five six", "ß x y"]
    whole = [s.tolist() for s in shingle_sets(pa.array(texts, pa.large_string()))]
    assert whole[1] == whole[3] and len(whole[1]) == 2 and whole[2] == []
    assert [s.tolist() for s in shingle_sets(pa.array(["pad", *texts], pa.string()).slice(1).cast(pa.large_string()))] == whole


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (300, 200), (7, 7)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "_a long, _b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


@pytest.mark.parametrize("order", ["descending", "random"])
def test_components_of_long_chains(spark, order):
    chain = list(range(2000))
    if order == "random":
        random.Random(6).shuffle(chain)
    else:
        chain = [0, *range(1999, 0, -1)]
    links = spark.createDataFrame([*zip(chain, chain[1:]), (5000, 5001)], "_a long, _b long")
    assert {r[0]: r[1] for r in components(links).collect()} == {**dict.fromkeys(range(2000), 0), 5000: 5000, 5001: 5000}


def test_nearest(spark):
    rng = np.random.RandomState(3)
    x = rng.randn(400, 16).astype(np.float32)
    x[10], x[11] = x[0], 2 * x[0]
    rows = [(i, [float(v) for v in x[i]], "extra") for i in range(400)]
    rows += [(None, rows[1][1], ""), (500, None, ""), (550, [], ""), (600, [0.0] * 16, ""), (650, [float("nan")] * 16, ""),
             (700, [1.0] * 15 + [None], ""), (750, [1.0, float("inf")] * 8, ""), (800, [1.0, 2.0], ""), (801, [2.0, 1.0], ""),
             (0, [-float(v) for v in x[0]], "same id as a query")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(5)
    got = collections.defaultdict(list)
    for r in nearest(df, F.col("vec_id") % 50 == 0, block_bytes=576, group=2, tile=7).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    assert set(got) == {*range(0, 400, 50), 800}
    assert got[800] == [(1, 801, pytest.approx(0.8))]
    for q in range(50, 400, 50):
        s = y @ y[q]
        s[q] = -2
        best = sorted(range(400), key=lambda i: (-round(s[i], 12), i))[:5]
        assert [v for _, v, _ in sorted(got[q])] == best
        assert np.allclose([v for *_, v in sorted(got[q])], s[best])
    assert nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_classifiers_hold_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, told = table(spark, sf, "documents"), table(spark, sf, "labels")
    for fn, label, fold, held, least in ((toxicity, "toxic", 5, 0, 0.97), (quality, "quality", 3, 1, 0.98)):
        got = fn(docs, told).toPandas()
        assert len(got) == docs.count() and got["score"].between(0, 1).all()
        assert ((got["score"] >= 0.5).astype(int) == got["predicted"]).all()
        assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % fold == held)).all()
        both = got[got["held_out"]].merge(told.toPandas(), on="doc_id")
        assert (both["predicted"] == both[label]).mean() >= least


def test_toxicity_of_long_texts(spark):
    sf = "/root/testdata/sf0.1"
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rng = random.Random(8)
    sentences = ["The river was wide and the boats came in with the tide", "She went on to read about trees",
                 "In 1901 the town had 40 houses", "It is on the map that they made"]
    clean = [" ".join(rng.choice(sentences) + "." for _ in range(n)) for n in (2000, 20000, 100000)]
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(clean)], "doc_id long, text string")
    got = toxicity(docs.unionAll(more), table(spark, sf, "labels")).where("doc_id < 0").collect()
    assert len(got) == 3 and all(r.predicted == 0 and not r.offending for r in got)


def test_toxicity_of_joined_clean_documents(spark):
    """Real clean documents, joined by the hundreds and thousands, stay clean; one toxic sentence among them is found."""
    from tessera.llm.sampling import id_remainder, labelled_sample

    sf, rng = "/root/testdata/sf0.1", random.Random(3)
    docs, marks = table(spark, sf, "documents"), table(spark, sf, "labels")
    w, bias = toxicity_module.learn(labelled_sample(docs, marks, "toxic", id_remainder("_id", 5) != 0, 6000))
    clean = [r.text for r in docs.join(marks.where("toxic = 0"), "doc_id").where("text IS NOT NULL").select("text").collect()]

    def score(texts):
        bags = toxicity_module.Bags(pa.array(texts, pa.large_string()))
        weights = np.array([w[toxicity_module.word_features(x)].sum() if x else 0.0 for x in bags.words.to_pylist()])
        return bags, *bags.noisy_or(weights, bias, 0.1)

    clean = [t for t, s in zip(clean, score(clean)[2]) if s < 0.05]
    assert len(clean) > 2000
    joined = ["\n".join(rng.choice(clean) for _ in range(n)) for n in (10, 300, 1000, 1000, 10000)]
    assert score(joined)[2].max() < 0.1
    planted = "You stupid pathetic idiot."
    assert score([planted])[2][0] >= 0.5
    for text in joined:
        bags, p, s = score([text + "\n" + planted])
        assert s[0] >= 0.5 and np.flatnonzero(p >= 0.5).tolist() == [len(p) - 1]


def test_noisy_or_by_hand_and_its_gradient():
    rng = np.random.RandomState(0)
    doc = np.array([0, 0, 0, 1, 1, 3, 3, 3])
    z, times, bias = rng.randn(8) * 2, np.array([1.0, 3, 2, 1, 4, 1, 1, 2]), -2.0
    y, weight = np.array([1.0, 0, 1, 0]), np.array([0.3, 0.2, 0.1, 0.4])
    q = 1 / (1 + math.exp(-bias))
    for margin in (0.0, 0.3):
        p, score = toxicity_module.leaky_or(z, doc, 4, bias, times, margin)
        for d in range(4):
            clean = 1 - q if d in doc else 1.0
            for i in np.flatnonzero(doc == d):
                assert math.isclose(p[i], 1 / (1 + math.exp(-z[i] - bias)))
                if z[i] > 0 and p[i] >= margin:
                    clean *= ((1 - p[i]) / (1 - q)) ** times[i]
            assert math.isclose(score[d], 1 - clean, abs_tol=1e-12)

    def loss(z, bias):
        s = np.clip(toxicity_module.leaky_or(z, doc, 4, bias, times)[1], 1e-300, 1 - 1e-16)
        held = np.isin(np.arange(4), doc)
        return -(weight * np.where(y == 1, np.log(s), np.log1p(-s)))[held].sum()

    dz, db = toxicity_module.gradient(z, doc, times, y, weight, bias)
    e = 1e-6
    assert math.isclose(db, (loss(z, bias + e) - loss(z, bias - e)) / (2 * e), rel_tol=1e-4)
    for i in range(8):
        step = np.eye(8)[i] * e
        assert math.isclose(dz[i], (loss(z + step, bias) - loss(z - step, bias)) / (2 * e), rel_tol=1e-4, abs_tol=1e-9)


def test_toxicity_learns_from_long_texts(spark):
    plain = "A plain line that says nothing of note. " * 600  # 24 KB
    rows = [(i, plain + ("You scoundrel. " if i % 2 else "")) for i in range(200)]
    got = toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                   spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)


def test_offending_sentences(spark):
    sf = "/root/testdata/sf0.1"
    docs = table(spark, sf, "documents")
    rows = toxicity(docs, table(spark, sf, "labels")).where("size(offending) > 0").limit(50).join(docs, "doc_id").collect()
    sentences = [r.text.encode()[s.begin:s.end].decode() for r in rows for s in r.offending]
    assert sentences and not any(re.search(r"[.!?\n]", s) for s in sentences)
    assert sum(bool(re.search("idiot|loser|scum|pathetic|moron|worthless|clown|disgusting|stupid|trash", s.lower())) for s in sentences) > 0


def test_classifiers_odd_rows(spark, odd, empty, labels):
    for fn in (toxicity, quality):
        got = fn(odd, labels).collect()
        assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
        assert all(r.held_out is False for r in got if r.doc_id is None)
        assert fn(empty, labels).count() == 0
        assert fn(odd, labels.limit(0)).count() == len(odd_rows())
    good = good_documents(odd, labels)
    assert good.columns == odd.columns and good.count() <= len(odd_rows())
    assert good_documents(empty, labels).count() == 0


def test_quality_trees():
    rng = np.random.RandomState(0)
    x = rng.rand(2000, 4)
    y = ((x[:, 1] > 0.6) ^ (x[:, 2] > 0.3)).astype(int)
    trees = grow(x, y, np.ones(2000))
    fresh = rng.rand(500, 4)
    assert ((trees.score(fresh) >= 0.5) == ((fresh[:, 1] > 0.6) ^ (fresh[:, 2] > 0.3))).mean() > 0.97

    def walk(row):  # one tree after the other, node by node
        z = trees.prior
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            for _ in range(trees.depth):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            z += leaf[node - (2 ** trees.depth - 1)]
        return 1 / (1 + math.exp(-z))
    assert np.allclose(trees.score(fresh[:50]), [walk(r) for r in fresh[:50]])
    s = statistics(pa.array(["", "aa aa BB\nx!", "É"], pa.large_string()))
    assert s.shape == (3, len(FEATURES)) and not np.isnan(s).any()
    assert s[1][FEATURES.index("repeats")] == 1 / 3 and s[1][FEATURES.index("distinct_words")] == 0.75


def tricky_texts():
    rng = random.Random(2)
    alphabet = "abcdefghij eit on re th \n\té日😀▁𐍈!"
    return ["", "a", " a", "  a b  ", "a\x00b", "▁a", "<s>hi</s>", "\n\n", "日本語 😀", "a▁b �", "   ", "x" * 500, "<0x41>",
            "            def f(x):\n\t\treturn   x"] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(400)]


def test_encoding_is_the_librarys(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    texts = tricky_texts()
    rows = {r.doc_id: r for r in encode_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                                                  model_path()).collect()}
    model = Model(open(model_path(), "rb").read())
    for i, t in enumerate(texts):
        ids = lib.encode(t, add_eos=True)
        assert rows[i].ids == ids and rows[i].decoded == lib.decode(ids)
        spans = [(p.begin, p.end) for p in lib.encode(t, return_type="proto").pieces]
        assert list(zip(rows[i].begins, rows[i].ends))[:-1] == spans
        assert (rows[i].begins[-1], rows[i].ends[-1]) == (len(t.encode()),) * 2
        ids2, begins, ends = encode_text(model, t)  # character by character
        assert (ids2, list(zip(begins, ends))) == (ids[:-1], spans)


def test_normalizer_is_the_librarys():
    import sentencepiece

    lib = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=True, escape_whitespaces=True,
                                                remove_extra_whitespaces=True)
    mine, rng = Normalizer(lib.serialized_normalizer_spec()), random.Random(4)
    for t in ["ﬁ  Ａ①", "  Hello   World ", "", "   ", "a​b", "½ ㍿ ™"] + ["".join(
            rng.choice("ﬁＡ① aé　éｶﾞ㍿\n\tz日") for _ in range(rng.randint(1, 30))) for _ in range(500)]:
        want, at = lib.normalize(t, with_offsets=True)
        got, spans = mine(t)
        assert got == want
        assert [len(t.encode()[:b].decode()) for b, _ in spans] == at[:len(spans)]


def test_token_counts(spark, odd, empty):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    texts = [r[1] for r in odd_rows()] + tricky_texts() + [" ".join(tricky_texts())]
    ids = [r[0] for r in odd_rows()] + list(range(1000, 1000 + len(texts) - len(odd_rows())))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    want = collections.Counter((i, len((t or "").encode()), len(lib.encode(t or ""))) for i, t in zip(ids, texts))
    for block in (1 << 16, 37):
        assert collections.Counter(tuple(r) for r in count_tokens(df, model_path(), block_chars=block).collect()) == want
    assert count_tokens(empty, model_path()).count() == 0
    coder = encode_documents(odd, model_path()).collect()
    assert len(coder) == len(odd_rows()) and all(r.ids == [2] for r in coder if r.doc_id in (0, 1))
    assert encode_documents(empty, model_path()).count() == 0


def test_block_maps_compose():
    transducer, rng = Transducer(Model(open(model_path(), "rb").read())), random.Random(7)
    count = transducer.count
    for t in tricky_texts()[:150]:
        if not t:
            continue
        s = " " + t
        cuts = sorted(rng.randint(0, len(s)) for _ in range(3))
        a, b, c, d = (block_map(count, s[i:j]) for i, j in zip([0, *cuts], [*cuts, len(s)]))
        left = compose(count, compose(count, compose(count, a, b), c), d)
        right = compose(count, a, compose(count, b, compose(count, c, d)))
        assert total_of(count, left) == total_of(count, right) == total_of_blocks(count, [a, b, c, d]) == sum(map(count, CHUNK.findall(s)))


def test_long_text_without_spaces():
    """Blocks that meet as text take time linear in it, and the tables stay bounded while the chunk runs."""
    import time

    import sentencepiece

    lib, rng = sentencepiece.SentencePieceProcessor(model_file=model_path()), random.Random(1)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60000))
    transducer = Transducer(Model(open(model_path(), "rb").read()), max_states=2000)
    assert transducer.count(" " + text) == len(lib.encode(text))
    assert len(transducer.states) < 2000 + 4097
    count, seconds = lambda chunk: len(chunk), []
    for n in (200, 400):
        maps = [block_map(count, "x" * 65536) for _ in range(n)]
        start = time.perf_counter()
        assert total_of_blocks(count, maps) == n * 65536
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 8 * seconds[0]


def test_pipeline(spark):
    import sentencepiece

    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.001"
    docs, seen = table(spark, sf, "documents"), []
    columns = docs.columns
    for name, apply in pipeline.STAGES:
        docs = apply(spark, docs, sf)
        seen.append(docs.toPandas())
        docs = spark.createDataFrame(seen[-1], docs.schema)
    assert all(list(x.columns) == columns for x in seen[:-1])
    good, single, apart, mixed, last = seen
    assert single.sort_values("doc_id")["doc_id"].tolist() == sorted(good.groupby("text")["doc_id"].max())
    want, _ = brute_components(list(zip(single["doc_id"], single["text"])))
    assert sorted(apart["doc_id"]) == sorted(i for i, c in want.items() if i == c)
    assert set(mixed["doc_id"]) <= set(apart["doc_id"]) and mixed["doc_id"].value_counts().max() <= 2
    lib, text = sentencepiece.SentencePieceProcessor(model_file=model_path()), dict(zip(mixed["doc_id"], mixed["text"]))
    assert sorted(last["doc_id"]) == sorted(mixed["doc_id"])
    assert all(list(ids) == lib.encode(text[i], add_eos=True) for i, ids in zip(last["doc_id"], last["ids"]))
    assert pipeline.run(spark, sf).count() == len(last)


def test_links_at_the_threshold(spark):
    """Pairs of similarity exactly 0.75 are linked, those just below are not; a column named like a helper's stays."""
    rng, rows, linked = random.Random(8), [], set()
    for i in range(400):
        words = [f"{rng.choice(WORDS)}{rng.randrange(10 ** 6)}" for _ in range(74)]
        own = 10 if i % 4 else 11  # 60 of 80 shingles in common, or 59 of 81
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-own] + [f"x{i}n{j}" for j in range(own)]))]
        if own == 10:
            linked.add(2 * i + 1)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_gone", F.lit(1)).withColumn("_gone_", F.lit(2))
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in near_duplicates(df).collect()}
    assert got == {i: (i - 1 if i in linked else i, 70) for i, _ in rows}
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.count() == 800 - len(linked)
