"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of
the summed weights of its distinct words; a word's weight is the sum of hashed
weights of the word and of its beginnings, so that inflected forms share
what is learned; buckets that the document labels show no tie to weigh nothing. The document's score is a noisy-or of
its sentences with one leak ``q``, the probability of a sentence that tells
nothing: ``1 - (1 - q) * prod((1 - p) / (1 - q))`` over the sentences with
``p > q``. Only sentences of a probability of ``margin`` or more count in a
score: the traces of evidence that innocent words leave would otherwise add up
over thousands of clean sentences, and a text be toxic for its length. Only
document labels train it (there every sentence with ``p > q`` counts): the
gradient of the document loss reaches each sentence in proportion to its own
probability. The sentence scores then locate the offending sentences.

The model is fitted on a sample of about ``max_rows`` documents of any length.
Tasks count the buckets' ties to the label and then reduce each document to its
distinct bags of tell-tale words with their numbers; only these reach the
driver. Scoring is one pass without a shuffle.

Defined results: null and empty texts have no sentences and score 0; labels of
null ids are ignored; null, repeated and unlabelled ids are scored like others;
without labelled rows of both classes every score is that of the prior weights.
Labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage
from tessera.llm.sampling import id_remainder, labelled_sample
from tessera.llm.textcols import codes_of, gather_ragged, owners, ragged, text_slices

SENTENCE_END, NOT_WORD = r"[.!?\n]", r"[^\pL\pN]+"
BUCKETS = 1 << 18
_CACHE_WORDS = 200_000


def word_features(word: str) -> list[int]:
    """Buckets of the word itself and of its beginnings of 3 to 5 letters."""
    marked = f"<{word}>"
    parts = [marked, *(marked[:n] for n in (4, 5, 6) if n < len(marked))]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in parts]


class Bags:
    """Documents of a slice as sentences and (sentence, word) pairs."""

    def __init__(self, texts):
        flat, offsets = ragged(pc.split_pattern_regex(texts, SENTENCE_END))
        size = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
        doc = owners(offsets)
        # separators are one byte each
        at = np.concatenate([[0], np.cumsum(size + 1)])
        begin = at[:-1] - np.repeat(at[offsets[:-1]], np.diff(offsets))
        words, word_offsets = ragged(pc.split_pattern_regex(pc.utf8_lower(flat), NOT_WORD))
        sentence = owners(word_offsets)
        code, self.words = codes_of(words)
        real = np.asarray(pc.greater(pc.binary_length(self.words), 0).to_numpy(zero_copy_only=False), dtype=bool)
        pairs = np.unique((sentence[real[code]] << 32) | code[real[code]]) if len(code) else np.zeros(0, np.int64)
        sentence, self.word = pairs >> 32, pairs & 0xFFFFFFFF
        kept, self.sentence = np.unique(sentence, return_inverse=True)
        self.n_docs, self.doc = len(texts), doc[kept]
        self.begin, self.end = begin[kept], (begin + size)[kept]

    def noisy_or(self, word_weight: np.ndarray, bias: float, margin: float):
        """Sentence probabilities and document scores."""
        return leaky_or(np.bincount(self.sentence, word_weight[self.word], len(self.doc)), self.doc, self.n_docs, bias, margin=margin)


def leaky_or(z: np.ndarray, doc: np.ndarray, n_docs: int, bias: float, times=1, margin: float = 0.0):
    """Probabilities of sentences with evidence ``z``, each standing for ``times`` sentences, and document scores."""
    p = 1 / (1 + np.exp(-np.clip(z + bias, -40, 40)))
    leak = -np.log1p(np.exp(np.clip(bias, -40, 40)))  # log(1 - q)
    more = np.where((z > 0) & (p >= margin), np.log1p(-np.minimum(p, 1 - 1e-12)) - leak, 0.0)
    none = np.bincount(doc, more * times, n_docs) + leak * (np.bincount(doc, minlength=n_docs) > 0)
    return p, -np.expm1(np.minimum(none, 0.0))


def _features_of(words, cache: dict[str, list[int]]) -> list[list[int]]:
    if len(cache) > _CACHE_WORDS:
        cache.clear()
    out = []
    for word in words.to_pylist():
        got = cache.get(word)
        if got is None:
            got = cache[word] = word_features(word) if word else []
        out.append(got)
    return out


def _bucket_counts(batches):
    """(_bucket, _docs, _toxic) of a task's documents; bucket -1 counts all of them."""
    docs, toxic, cache = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64), {}
    for part, texts in text_slices(batches):
        y = part.column("_y").to_numpy(zero_copy_only=False).astype(np.int64)
        bags = Bags(texts)
        features = _features_of(bags.words, cache)
        length = np.array([len(f) for f in features], np.int64)
        flat = np.fromiter((b for f in features for b in f), np.int64, length.sum())
        starts = np.cumsum(length) - length
        # documents and words, then documents and buckets
        pairs = np.unique((bags.doc[bags.sentence] << 32) | bags.word)
        doc, word = pairs >> 32, pairs & 0xFFFFFFFF
        pairs = np.unique((np.repeat(doc, length[word]) << 32) | gather_ragged(flat, starts[word], length[word]))
        doc, bucket = pairs >> 32, pairs & 0xFFFFFFFF
        docs += np.bincount(np.append(bucket, np.full(len(y), BUCKETS)), minlength=BUCKETS + 1)
        toxic += np.bincount(np.append(bucket[y[doc] == 1], np.full(int(y.sum()), BUCKETS)), minlength=BUCKETS + 1)
    seen = np.flatnonzero(docs)
    yield pa.RecordBatch.from_arrays([pa.array(np.where(seen == BUCKETS, -1, seen)), pa.array(docs[seen]), pa.array(toxic[seen])],
                                     names=["_bucket", "_docs", "_toxic"])


def associated(with_it: np.ndarray, toxic: np.ndarray, n: float, t: float) -> np.ndarray:
    """Buckets tied to the label: chi-squared of document presence above 2 ln(buckets seen),
    where about one bucket would come through by chance. Takes the documents and the toxic
    documents of each bucket and of the whole sample."""
    with_it, toxic = with_it.astype(float), toxic.astype(float)
    spread = with_it * (n - with_it) * t * (n - t)
    chi = n * (toxic * n - with_it * t) ** 2 / np.maximum(spread, 1.0)
    return chi > 2 * np.log(max(2, np.count_nonzero(with_it)))


def told_bags(texts, use: np.ndarray, cache: dict[str, list[int]]) -> list[Counter]:
    """For each text its distinct bags of tell-tale words (sorted tuples) and how many sentences have each."""
    bags = Bags(texts)
    told = np.array([bool(f) and bool(use[f].any()) for f in _features_of(bags.words, cache)], bool)
    tell = told[bags.word]
    sentence, word = bags.sentence[tell], bags.word[tell]
    out = [Counter() for _ in range(bags.n_docs)]
    cuts = np.flatnonzero(np.diff(sentence)) + 1
    for at, bag in zip(sentence[np.append(0, cuts)] if len(sentence) else [], np.split(word, cuts)):
        out[bags.doc[at]][tuple(sorted(bags.words[int(w)].as_py() for w in bag))] += 1
    for doc, n in enumerate(np.bincount(bags.doc, minlength=bags.n_docs).tolist()):
        blank = n - out[doc].total()
        if blank:
            out[doc][()] = blank
    return out


def _told(use: np.ndarray):
    def run(batches):
        cache: dict[str, list[int]] = {}
        for part, texts in text_slices(batches):
            got = [sorted(c.items()) for c in told_bags(texts, use, cache)]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in ("_id", "_hash", "_y", "_weight")]
                + [pa.array([[b for b, _ in c] for c in got], pa.list_(pa.list_(pa.string()))),
                   pa.array([[n for _, n in c] for c in got], pa.list_(pa.int64()))],
                names=["_id", "_hash", "_y", "_weight", "_bags", "_times"])
    return run


def gradient(z: np.ndarray, doc: np.ndarray, times: np.ndarray, y: np.ndarray, weight: np.ndarray, bias: float):
    """Of the weighted document log-loss: by the evidence of each (repeated) sentence and by the bias.

    A sentence is pulled down by p in a clean document and up by p (1 - P) / P
    in a toxic one; one without evidence only moves the leak.
    """
    p, score = leaky_or(z, doc, len(y), bias, times)
    q = 1 / (1 + np.exp(-bias))
    pull = np.where(y == 1, -(1 - score) / np.maximum(score, 1e-9), 1.0) * weight
    dz = np.where(z >= 0, p * pull[doc] * times, 0.0)
    db = q * pull[np.unique(doc)].sum() + (np.where(z > 0, p - q, 0.0) * pull[doc] * times).sum()
    return dz, db


def fit(bags: list, times: list, y: np.ndarray, weight: np.ndarray, use: np.ndarray, steps: int = 300, rate: float = 0.1,
        decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights of the buckets and the bias, by Adam on the weighted document log-loss.

    ``bags`` and ``times`` are, for each document, its distinct bags of tell-tale words and their numbers.
    """
    w, bias = np.zeros(BUCKETS), -3.0
    if len(y) == 0 or len(set(y.tolist())) < 2:
        return w, bias
    y, weight = y.astype(float), weight / weight.sum()
    doc = np.repeat(np.arange(len(y)), [len(b) for b in bags])
    times = np.array([n for t in times for n in t], float)
    length = np.array([len(b) for d in bags for b in d], np.int64)
    code, words = codes_of(pa.array([x for d in bags for b in d for x in b], pa.string()))
    sentence = np.repeat(np.arange(len(length)), length)
    features = [[b for b in word_features(x) if use[b]] for x in words.to_pylist()]
    owner = np.repeat(np.arange(len(features)), [len(f) for f in features])
    bucket, flat = np.unique(np.array([b for f in features for b in f], np.int64), return_inverse=True)
    small = np.zeros(len(bucket))
    m1, v1, m2, v2 = np.zeros(len(bucket)), np.zeros(len(bucket)), 0.0, 0.0
    for t in range(1, steps + 1):
        weights = np.bincount(owner, small[flat], len(features))
        z = np.bincount(sentence, weights[code], len(doc))
        dz, db = gradient(z, doc, times, y, weight, bias)
        dword = np.bincount(code, dz[sentence], len(features))
        dw = np.bincount(flat, dword[owner], len(bucket)) + decay * small
        m1, v1 = 0.9 * m1 + 0.1 * dw, 0.99 * v1 + 0.01 * dw * dw
        m2, v2 = 0.9 * m2 + 0.1 * db, 0.99 * v2 + 0.01 * db * db
        pace = rate * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t)
        small = small - pace * m1 / (np.sqrt(v1) + 1e-9)
        bias = float(bias - pace * m2 / (np.sqrt(v2) + 1e-9))
    w[bucket] = small
    return w, bias


def learn(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and bias from (_id, text, _y, _weight)."""
    kind = sample.schema["_id"].dataType.simpleString()
    sample = stage(sample.select("_id", F.xxhash64("text").alias("_hash"), F.col("_y").cast("int").alias("_y"), "_weight", "text"),
                   "toxicity-sample")
    counts = (sample.select("_y", "text").mapInArrow(_bucket_counts, "_bucket long, _docs long, _toxic long")
              .groupBy("_bucket").agg(F.sum("_docs").alias("_docs"), F.sum("_toxic").alias("_toxic")).toPandas())
    with_it, toxic = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)  # the last place holds bucket -1
    with_it[counts["_bucket"].to_numpy(int)], toxic[counts["_bucket"].to_numpy(int)] = counts["_docs"], counts["_toxic"]
    use = associated(with_it[:-1], toxic[:-1], with_it[-1], toxic[-1])
    got = sample.mapInArrow(_told(use), f"_id {kind}, _hash long, _y int, _weight double, _bags array<array<string>>, "
                                        "_times array<long>").toArrow().sort_by([("_id", "ascending"), ("_hash", "ascending")])
    return fit(got["_bags"].to_pylist(), got["_times"].to_pylist(), got["_y"].to_numpy(), got["_weight"].to_numpy().astype(float), use)


def _scorer(w: np.ndarray, bias: float, locate: float, margin: float):
    def run(batches):
        cache: dict[str, float] = {}
        for part, texts in text_slices(batches):
            bags = Bags(texts)
            weights = np.zeros(len(bags.words))
            if len(cache) > _CACHE_WORDS:
                cache.clear()
            for i, word in enumerate(bags.words.to_pylist()):
                if word:
                    got = cache.get(word)
                    if got is None:
                        got = cache[word] = float(w[word_features(word)].sum())
                    weights[i] = got
            p, score = bags.noisy_or(weights, bias, margin)
            bad = np.flatnonzero(p >= locate)
            spans = pa.StructArray.from_arrays(
                [pa.array(bags.begin[bad], pa.int32()), pa.array(bags.end[bad], pa.int32()), pa.array(p[bad], pa.float64())],
                ["begin", "end", "score"])
            offsets = np.searchsorted(bags.doc[bad], np.arange(bags.n_docs + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(score, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)],
                names=["id", "score", "offending"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", folds: int = 5, held_fold: int = 0, max_rows: int = 6000,
             locate: float = 0.5, margin: float = 0.1) -> DataFrame:
    """Per document: id, ``held_out``, ``score``, ``predicted`` and ``offending`` sentences (byte offsets, score)."""
    w, bias = learn(labelled_sample(docs, labels, label_col, id_remainder("_id", folds) != held_fold, max_rows, id_col, text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _scorer(w.astype(np.float32), bias, locate, margin),
        f"id {kind}, score double, offending array<struct<begin:int,end:int,score:double>>")
    return out.select(
        F.col("id").alias(id_col), F.coalesce(id_remainder("id", folds) == held_fold, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")
