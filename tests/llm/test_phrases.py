"""Phrase mining against brute force, on small tables and edge cases."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
from conftest import SF001
from pyspark.sql import functions as F

from vigil.llm import toivonen
from vigil.llm.words import BitFilter, bit_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, least, most=5, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    covered = {(lang, p[i:j]) for (lang, p), a in cand.items() for i in range(len(p))
               for j in range(i + 2, len(p) + 1) if j - i < len(p) and a >= f[lang, p[i:j]]}
    out = {}
    for (lang, p), a in cand.items():
        if (lang, p) in covered:
            continue
        cuts = [(Fraction(1000 * a * n[lang], f[lang, p[:k]] * f[lang, p[k:]]).__floor__(), k)
                for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -score) for lang, own in out.items()
                  for i, (score, a, p, l, r) in enumerate(sorted(own)[:top]))


def found(df, least, top=2000, **options):
    mined = toivonen.ranked(toivonen.mine(df, least=least, **options), top)
    return sorted(tuple(r) for r in mined.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_phrases_equal_brute_force(spark):
    """With hardly a sample most phrases are failures of the border."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert found(docs, 12, sample=0.03) == brute(rows, 12)


def test_phrases_edge_cases(spark):
    rng = random.Random(4)
    words = ["a", "B", "c\x00", "é", "ß-x", " ", "x"]
    long = " ".join(rng.choice(words) for _ in range(40_000))
    rows = [(1, "tick tock, tick tock! TICK tock", "en"), (1, "tick tock, tick tock! TICK tock", "en"),
            (None, "tick\ttock tick  tock\ntick tock", None), (2, None, "en"), (3, "", "de"), (4, " ,;\n", None),
            (5, long, "en"), (6, long.replace(" ", ","), "und"), (7, "a a a a a a a a", "aa")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(3)
    for c in ("h", "n", "a", "rank", "phrase", "words", "__key"):
        df = df.withColumn(c, F.lit("clash"))
    want = brute([r[1:] for r in rows], 3)
    assert found(df, 3) == want and any(r[0] == "und" for r in want)
    assert found(df, 3, top=2, id_col=None, sample=0.0) == brute([r[1:] for r in rows], 3, top=2)
    assert found(df.where("text IS NULL"), 1) == []


def test_long_texts_are_cut_at_stops_only():
    text = (b"one two three. " * 200_000)
    parts = list(toivonen.words.pieces(text))
    assert len(parts) > 1 and sum(parts, []) == toivonen.words(text)
    assert all(p[-1] == b"\xff" for p in parts[:-1])


def test_bit_filter_has_its_keys(spark):
    keys = np.random.default_rng(3).integers(-2 ** 63, 2 ** 63, 4000)
    df = spark.createDataFrame([(int(k),) for k in keys], "h long")
    f = bit_filter(df, "h", 16)
    assert f.has(keys.view(np.uint64)).all()
    others = np.random.default_rng(4).integers(0, 2 ** 63, 20_000).astype(np.uint64)
    assert 0 < f.has(others).mean() < 0.05 and not BitFilter(16).has(others).any()
