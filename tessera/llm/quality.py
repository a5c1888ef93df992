"""Quality classifier: histogram gradient-boosted trees over document statistics.

One vectorised pass turns each whole text into a row of statistics (sizes,
byte classes, entropy, repetition of words, word pairs and lines). Trees of a
fixed depth grow on binned statistics of a bounded sample and are flattened
into arrays (feature, threshold, leaf value per node), so that scoring is
``depth`` numpy gathers for all trees and documents of a slice at once.

Defined results: null and empty texts have all statistics 0 and are scored like
others; labels of null ids are ignored; null and repeated ids are scored row by
row; without labelled rows of both classes every score is the prior's. Labels,
language, source and id are no inputs of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.sampling import id_remainder, labelled_sample
from tessera.llm.textcols import codes_of, owners, ragged, sums, text_slices

FEATURES = ("log_bytes", "log_words", "word_bytes", "word_bytes_sd", "upper", "digit", "space", "newline", "exclaim",
            "sentence_marks", "commas", "other_marks", "control", "high_bytes", "entropy", "distinct_words",
            "top_word", "repeats", "distinct_pairs", "log_lines", "distinct_lines", "line_words", "short_words", "long_words",
            "caps_words")


def _byte_classes() -> np.ndarray:
    """256 x classes: which byte counts for which share."""
    b = np.arange(256)
    marks = ((b >= 33) & (b <= 47)) | ((b >= 58) & (b <= 64)) | ((b >= 91) & (b <= 96)) | ((b >= 123) & (b <= 126))
    told = np.isin(b, [ord(c) for c in "!.?,"])
    return np.stack([(b >= 65) & (b <= 90), (b >= 48) & (b <= 57), np.isin(b, [32, 9]), b == 10, b == 33,
                     np.isin(b, [46, 63]), b == 44, marks & ~told, (b < 32) & ~np.isin(b, [9, 10, 13]), b >= 128], axis=1).astype(float)


def _distinct(keys: np.ndarray, owner: np.ndarray, n: int):
    """Per owner: number of distinct keys and the count of the commonest."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])]))
    counts = np.diff(np.concatenate([new, [len(k)]]))
    top = np.zeros(n)
    np.maximum.at(top, o[new], counts)
    return np.bincount(o[new], minlength=n).astype(float), top


def statistics(texts) -> np.ndarray:
    """Documents x FEATURES for a large_string array without nulls."""
    n = len(texts)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n, dtype=np.int64) << 8, size)
    histogram = np.bincount(doc | data, minlength=n << 8).reshape(n, 256) if n else np.zeros((0, 256))
    share = histogram / np.maximum(1, size)[:, None]
    entropy = -(share * np.log2(np.maximum(share, 1e-12))).sum(axis=1)
    del doc, histogram

    flat, word_at = ragged(pc.ascii_split_whitespace(texts))
    code, words = codes_of(flat)
    length = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    caps = np.asarray(pc.and_(pc.equal(words, pc.ascii_upper(words)), pc.not_equal(words, pc.ascii_lower(words)))
                      .to_numpy(zero_copy_only=False), dtype=float)
    owner = owners(word_at)
    keep = length[code] > 0  # an outer white space leaves an empty string
    code, owner = code[keep], owner[keep]
    n_words = np.bincount(owner, minlength=n).astype(float)
    ends = np.concatenate([[0], np.cumsum(n_words)]).astype(np.int64)
    some = np.maximum(1, n_words)
    wide = length[code].astype(float)
    mean = sums(wide, ends) / some
    spread = np.sqrt(np.maximum(0, sums(wide * wide, ends) / some - mean * mean))
    distinct, top = _distinct(code, owner, n)
    inside = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    pair, pair_owner = (code[:-1] * len(words) + code[1:])[inside], owner[1:][inside]
    pairs, _ = _distinct(pair, pair_owner, n)
    n_pairs = np.maximum(1, np.bincount(pair_owner, minlength=n))
    repeats = np.bincount(pair_owner, (code[:-1] == code[1:])[inside], n) / n_pairs
    lines, line_at = ragged(pc.split_pattern(texts, "\n"))
    line_code, _ = codes_of(lines)
    distinct_lines, _ = _distinct(line_code, owners(line_at), n)
    n_lines = np.maximum(1, np.diff(line_at))
    own = (share @ _byte_classes()).T
    return np.column_stack([
        np.log1p(size), np.log1p(n_words), mean, spread, *own, entropy, distinct / some, top / some, repeats,
        pairs / n_pairs, np.log1p(n_lines), distinct_lines / n_lines, n_words / n_lines,
        sums((wide <= 3).astype(float), ends) / some, sums((wide > 15).astype(float), ends) / some, sums(caps[code], ends) / some])


class Trees:
    """Boosted trees of one depth as arrays: tree x inner node, tree x leaf."""

    def __init__(self, depth: int, prior: float):
        self.depth, self.prior = depth, prior
        self.feature, self.threshold, self.leaf = [], [], []

    def flatten(self) -> "Trees":
        self.feature, self.threshold, self.leaf = (np.array(x) for x in (self.feature, self.threshold, self.leaf))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature) or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.prior)))
        node = np.zeros((len(x), len(self.feature)), np.int64)
        tree, row = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        for _ in range(self.depth):
            right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        z = self.prior + self.leaf[tree, node - (2 ** self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, depth: int = 4, bins: int = 64,
         rate: float = 0.15, ridge: float = 1.0, least: float = 4.0) -> Trees:
    """Boost ``rounds`` trees on the weighted log-loss, splits from histograms of gradients."""
    weight = weight * len(y) / max(weight.sum(), 1e-9) if len(y) else weight
    mean = float(np.average(y, weights=weight)) if len(y) else 0.5
    mean = min(max(mean, 1e-3), 1 - 1e-3)
    trees = Trees(depth, float(np.log(mean / (1 - mean))))
    if len(set(y.tolist())) < 2:
        return trees.flatten()
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])  # bin <= b: x <= cuts[b]
    z = np.full(len(y), trees.prior)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)  # number within its level
        feature, threshold = [], []
        for level in range(depth):
            width = 2 ** level
            best = np.full(width, 1e-6)
            f_of, b_of = np.zeros(width, np.int64), np.full(width, bins + 1)
            total_g, total_h = (np.bincount(node, v, width) for v in (g, h))
            for f in range(x.shape[1]):
                key = node * bins + binned[:, f]
                left_g, left_h, left_n = (np.bincount(key, v, width * bins).reshape(width, bins).cumsum(axis=1)
                                          for v in (g, h, weight))
                right_n = left_n[:, -1:] - left_n
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = (left_g ** 2 / (left_h + ridge) + right_g ** 2 / (right_h + ridge)
                        - (total_g ** 2 / (total_h + ridge))[:, None])
                gain[(left_n < least) | (right_n < least)] = 0
                gain[:, len(cuts[f]):] = 0
                b = gain.argmax(axis=1)
                better = gain[np.arange(width), b] > best
                best[better], f_of[better], b_of[better] = gain[np.arange(width), b][better], f, b[better]
            # a node without a useful split sends everything left
            threshold += [cuts[f][b] if b <= bins else np.inf for f, b in zip(f_of, b_of)]
            feature += f_of.tolist()
            node = 2 * node + (binned[np.arange(len(y)), f_of[node]] > b_of[node])
        leaf = -rate * np.bincount(node, g, 2 ** depth) / (np.bincount(node, h, 2 ** depth) + ridge)
        trees.feature.append(feature)
        trees.threshold.append(threshold)
        trees.leaf.append(leaf)
        z = z + leaf[node]
    return trees.flatten()


def _measured(batches):
    for part, texts in text_slices(batches):
        yield pa.RecordBatch.from_arrays(
            [part.column("_id"), part.column("_y"), part.column("_weight"),
             pa.array(list(statistics(texts)), pa.list_(pa.float64()))], names=["_id", "_y", "_weight", "_x"])


def _scorer(trees: Trees):
    def run(batches):
        for part, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(trees.score(statistics(texts)), pa.float64())],
                                             names=[*part.schema.names[:-1], "score"])
    return run


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", folds: int = 3, held_fold: int = 1, max_rows: int = 20000, **options) -> Trees:
    """Trees fitted on the statistics (not the texts) of about ``max_rows`` labelled documents."""
    sample = labelled_sample(docs, labels, label_col, id_remainder("_id", folds) != held_fold, max_rows, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    got = sample.select("_id", F.col("_y").cast("int").alias("_y"), "_weight", "text").mapInArrow(
        _measured, f"_id {kind}, _y int, _weight double, _x array<double>").toPandas()
    x = np.array(got["_x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    order = np.lexsort((*x.T, got["_id"].to_numpy()))  # the sample's order mustn't depend on the partitioning
    return grow(x[order], got["_y"].to_numpy()[order], got["_weight"].to_numpy(float)[order], **options)


def score_quality(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """One row per document: ``_row`` (all columns of ``docs``) and ``score``."""
    struct = f"struct<{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in docs.schema)}>"
    return docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).alias("text")).mapInArrow(
        _scorer(trees), f"_row {struct}, score double")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 3,
            held_fold: int = 1, **options) -> DataFrame:
    """Per document: id, ``held_out``, ``score``, ``predicted``."""
    trees = fit_quality(docs, labels, id_col, text_col, folds=folds, held_fold=held_fold, **options)
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).mapInArrow(
        _scorer(trees), f"_id {kind}, score double")
    return out.select(
        F.col("_id").alias(id_col), F.coalesce(id_remainder("_id", folds) == held_fold, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, least: float = 0.5, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without those scored below ``least``; same columns."""
    trees = fit_quality(docs, labels, text_col=text_col, **options)
    scored = score_quality(docs, trees, text_col).where(F.col("score") >= least)
    return scored.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
