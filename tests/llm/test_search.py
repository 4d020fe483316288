"""Ranked search against brute force, on small tables and edge cases."""

import math
import random
import re

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from vigil.llm import term_pipeline
from vigil.llm.term_pipeline import search

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    """Sorted (item, rank, score); and which documents have each score."""
    sets = [(i, split(t)) for i, t in docs]
    sets = [(i, w) for i, w in sets if w]
    n_docs, n_terms = len(sets), sum(len(w) for _, w in sets)
    df = {}
    for _, w in sets:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        terms = {t for t in split(text) if t in df}
        ranked = []
        for i, w in sets:
            m = 100 - 90 + 90 * len(w) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in terms if t in w)
            if score > 0:
                ranked.append((-score, i is None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(ranked, key=lambda r: r[:3])[:top], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_search_equals_brute_force_in_small_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(search(docs, items)) == want
    # several bundles of items, one owner
    assert found(search(docs.repartition(5), items, bundle_bytes=4000, owners=1)) == want


def test_search_edge_cases(spark):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("Alpha beta gamma δέλτα 7up zeta eta".split()) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 30))) for i in range(60)] + [
        (61, None), (62, ""), (63, " ;;\n"), (None, text(9)), (None, text(9)), (5, text(6)), (64, text(50_000)),
        (65, "same rare words"), (66, "same rare words"), (67, "SAME-rare_words"), (67, "same rare words")]
    items = [(1, "alpha; BETA beta"), (1, "alpha; BETA beta"), (1, "zeta"), (2, None), (3, ""), (None, "gamma eta"),
             (4, "nowhere"), (5, "rare words"), (6, text(300))]
    df = spark.createDataFrame([(*d, None, None, None) for d in docs], SCHEMA).repartition(3)
    for c in ("item", "score", "rank", "block", "payload", "id", "n"):
        df = df.withColumn(c, F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    assert found(search(df, bench)) == brute(docs, items)
    assert found(search(df, bench, top=3, owners=7)) == brute(docs, items, 3)
    assert search(df.limit(0), bench).count() == 0 == search(df, bench.limit(0)).count()
    everywhere = spark.createDataFrame([(i, "all", "", "", 1) for i in range(20)], SCHEMA)
    one = spark.createDataFrame([(1, "all")], "item_id long, text string")
    assert found(search(everywhere, one)) == brute([(i, "all") for i in range(20)], [(1, "all")])


@pytest.mark.parametrize("owners", [1, 2, 5])
def test_owners_leave_nothing_behind_that_could_win(monkeypatch, owners):
    """All visits in turn, in memory: the best of a block are those of the sums."""
    rng = np.random.default_rng(owners)
    monkeypatch.setattr(term_pipeline, "TILE", 3)
    n_items, n_terms, n = 6, 12, 90
    bundle = term_pipeline.Bundle(list(range(n_items)), {}, *np.nonzero(rng.random((n_items, n_terms)) < 0.5))
    times = rng.integers(0, 3, (n_terms, n)) * (rng.random((n_terms, n)) < np.linspace(0.02, 0.9, n_terms)[:, None])
    term, doc = np.nonzero(times)
    postings = (term, doc, times[term, doc])
    df = np.bincount(term, minlength=n_terms)
    plan = term_pipeline.weigh(bundle, df, n, 50 * n, owners)
    size = rng.integers(1, 100, n)
    whole = np.zeros((n_items, n), np.int64)
    live = plan.owner[term] >= 0
    term_pipeline.add_contributions(whole, plan, size, [x[live] for x in postings])
    value = type("V", (), {"value": plan})
    row = {"block": [0], "doc_id": [list(range(n))], "n": [size.tolist()], "item": [[]], "doc": [[]], "score": [[]]}
    import pyarrow as pa
    state = pa.table({f.name: pa.array(row[f.name], f.type) for f in term_pipeline.CARRIED})
    carried = []
    for k in range(owners):
        own = plan.owner[term] == k
        raw = term_pipeline._pack(*[x[own] for x in postings])
        right = pa.table({"block": [0], "payload": pa.array([raw], pa.binary())})
        state = term_pipeline._visit(value, k, 5, k == owners - 1)(state, right)
        if k < owners - 1:
            carried.append(len(state.column("score")[0]))
    want = sorted((i, d, int(whole[i, d])) for i in range(n_items)
                  for d in np.lexsort((np.arange(n), -whole[i]))[:5].tolist() if whole[i, d] > 0)
    assert sorted(zip(*[state.column(c).to_pylist() for c in ("item", "doc_id", "score")])) == want
    assert all(c <= n_items * n for c in carried)
