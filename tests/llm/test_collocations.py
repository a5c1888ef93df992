"""Collocations against counting in plain Python."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.collocations import Words, _portions, collocations, count_stream, frequent_phrases

SCHEMA = "doc_id long, text string, lang string, source string, phrase string, f long, n long, w string, _pid int"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_counts(rows):
    f = collections.Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                f.update(("und" if lang is None else lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    return f


def brute(rows, least, top):
    f = brute_counts(rows)
    n = collections.Counter()
    for (lang, w), c in f.items():
        n[lang] += c * (len(w) == 1)
    cand = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    inside = lambda w, v: any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))
    out = collections.defaultdict(list)
    for (lang, w), a in cand.items():
        if any(g == lang and len(v) > len(w) and 100 * c >= 100 * a and inside(w, v) for (g, v), c in cand.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                    for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for lang, v in out.items()
                  for r, (s, a, p, left, right) in enumerate(sorted(v)[:top]))


def odd_rows(seed=2, n=150):
    rng = random.Random(seed)
    vocabulary = ["hot"] * 6 + ["New", "york", "É", "été", "of", "the", "a\x01", "x\x00y", "日本", "-", "hot dog"]
    phrases = ["new York city hall.", "the end of the world, of", "a b c d e f g", "once only", "hot hot hot hot hot hot"]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary + phrases) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "?"]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None, "und", ""]), "s", "p", 1, 2, "w", 3))
    rows += [(None, None, "en", None, None, None, None, None, None), (1, "", None, None, None, None, None, None, None),
             (2, " \t.;", "en", None, None, None, None, None, None), (3, "very long " * 9000, "fr", None, None, None, None, None, None),
             (4, "n" * 50000, "fr", None, None, None, None, None, None), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("bits, max_bytes", [(1 << 20, 4 << 20), (64, 300)])  # a bitmap of 64 bits lets nearly all through
def test_matches_brute_force(spark, bits, max_bytes):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in collocations(df, min_count=10, per_lang=25, n_bits=bits, max_bytes=max_bytes).collect())
    assert got == brute(rows, 10, 25) and len({r[0] for r in got}) >= 4


def test_empty(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations(spark.createDataFrame(odd_rows(n=5)[-7:-3], SCHEMA), min_count=10 ** 6).count() == 0


def test_streams_cross_partitions(spark):
    """Every phrase begins with the same word: its beginnings lie in an earlier partition of nearly all rows."""
    rng = random.Random(4)
    texts = [(i, "hot " + " ".join(rng.choice("abcde") for _ in range(6)), "en") for i in range(400)]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    found, total = frequent_phrases(df, 5, 3, 1 << 16, 1 << 16)
    want = {w: c for (_, w), c in brute_counts(texts).items() if c >= 3}
    assert {tuple(r.phrase.split(" ")): r.f for r in found.collect()} == want
    assert [tuple(r) for r in total.collect()] == [("en", 2800)]
    for back in (False, True):
        words = F.split("phrase", " ")
        stream = count_stream(found, F.reverse(words) if back else words, "t").collect()
        turn = (lambda w: w[::-1]) if back else (lambda w: w)
        assert len(stream) == len(want)
        longest = collections.Counter()
        for w, c in want.items():
            longest[turn(w)[:-1]] = max(longest[turn(w)[:-1]], c)
        for r in stream:
            w = tuple(r.w)
            assert r.f == want[turn(w)] and r.heads == [want[turn(w[:j])] for j in range(1, len(w))] and r.extended == longest[w]


def test_portions_cover_texts():
    rng = np.random.default_rng(1)
    for most in (1, 7, 50):
        data = rng.choice(np.frombuffer(b"ab .\n", np.uint8), 400)
        starts = np.unique(np.append(0, rng.integers(0, 400, 5)))
        spans = list(_portions(data, starts, most))
        assert [a for a, _ in spans][1:] == [b for _, b in spans][:-1] and spans[0][0] == 0 and spans[-1][1] == 400
    w = Words(np.frombuffer(b"A b.aB c", np.uint8), np.array([0, 6]), np.array([0, 1]))
    assert [w.words[i].as_py() for i in w.codes.tolist()] == [b"a", b"b", b"ab", b"c"]
    assert w.lang.tolist() == [0, 0, 0, 1] and w.together.tolist() == [True, False, False, False]
