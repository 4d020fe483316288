"""Benchmark decontamination against brute force, on small tables and edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SF001
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vigil.llm import suffix_automaton
from vigil.llm.queries import op12_decontaminate
from vigil.llm.suffix_automaton import Automaton, decontaminate

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    """n_words, n_hit, sorted ids of items hit (as strings, null last)."""
    own, hit, found = split(text), set(), set()
    for item, s in items:
        w = split(s)
        m = min(len(w), window)
        parts = {tuple(w[i:i + m]) for i in range(len(w) - m + 1)} if w else ()
        for i in range(len(own) - m + 1 if w else 0):
            if tuple(own[i:i + m]) in parts:
                hit |= set(range(i, i + m))
                found.add(item)
    return len(own), len(hit), sorted(map(str, found - {None})) + [None] * (None in found)


def got(df):
    return [(r.n_words, r.n_hit, r.item_ids) for r in df.collect()]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    found = {r.doc_id: r for r in op12_decontaminate(spark, SF001).collect()}
    assert len(found) == len(docs)
    for d in docs:
        n, hit, ids = brute(d.text, items, 10)
        r = found[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert any(r.contaminated for r in found.values()) and not all(r.contaminated for r in found.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=9), max_size=6),
       st.lists(st.sampled_from("abcde"), max_size=40), st.integers(1, 5))
def test_automaton_equals_brute_force(items, doc, window):
    a = Automaton([(i, [w.encode() for w in s]) for i, s in enumerate(items)], window)
    ids = a.ids([w.encode() for w in doc])
    hit, found = a.hits(ids)
    _, n, want = brute(" ".join(doc), [(i, " ".join(s)) for i, s in enumerate(items)], window)
    assert hit.sum() == n and sorted(map(str, found)) == want
    inside = {tuple(s[i:j]) for s in items for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for end, n in enumerate(a.lengths(ids), 1):
        assert n == max([k for k in range(1, end + 1) if tuple(doc[end - k:end]) in inside], default=0)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(7)
    word = lambda: rng.choice("alpha Beta gamma 7 été ß zeta".split())
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(1, text(40)), (1, text(15)), (10, text(4)), (2, "solo"), (3, None), (4, " ;\n"), (None, text(12)),
             (5, "one two three four five six seven eight nine ten eleven twelve")]
    docs = [(1, text(30) + ", " + items[0][1].upper() + "! " + text(5)), (1, items[0][1]), (2, None), (None, items[6][1]),
            (3, ""), (4, "SOLO"), (5, text(60_000)), (6, items[2][1].replace(" ", "--")), (5, items[5][1] if items[5][1] else ""),
            (7, "intro. " + items[7][1] + " outro"), (7, "intro. " + items[7][1] + " outro"), (8, "x" * 100_000)]
    return docs, items


def test_edge_cases(spark, odd):
    docs, items = odd
    df = spark.createDataFrame([(*d, None, None, None) for d in docs], SCHEMA).coalesce(1)
    for c in ("__row", "__text", "hit", "items", "N_WORDS", "spans", "id", "n_hit"):
        df = df.withColumn(c, F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit("clash"))
    want = [brute(t, items, 10) for _, t in docs]
    assert sorted(got(decontaminate(df, bench)), key=repr) == sorted(want, key=repr)
    # several automata, items longer than one
    assert sorted(got(decontaminate(df, bench, shard_words=16)), key=repr) == sorted(want, key=repr)
    out = decontaminate(df, bench, columns=["doc_id", "text"])
    assert out.columns[:2] == ["doc_id", "text"]
    assert decontaminate(df.limit(0), bench).count() == 0
    for none in (bench.limit(0), bench.where("text IS NULL")):
        assert all(n == 0 and not ids for _, n, ids in got(decontaminate(df, none)))


def test_spans_are_cut_and_covered_documents_dropped(spark, odd):
    docs, items = odd
    item = items[7][1]
    df = spark.createDataFrame([(1, f"Ünö, {item.title()}; rest", "", "", 1), (2, item, "", "", 1),
                                (3, "clean " * 30 + item, "", "", 1), (4, None, "", "", 1)], SCHEMA)
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate(df, bench, span_limit=12).collect()}
    assert rows[1].clean_text == "Ünö, ; rest" and rows[1].dropped and rows[2].clean_text == ""
    assert rows[3].clean_text == "clean " * 30 and not rows[3].dropped and rows[3].contaminated
    assert rows[4].clean_text is None and not rows[4].contaminated and not rows[4].dropped
    (span,) = rows[1].spans
    assert (span.word, span.words) == (1, 12) and rows[1].text[span.start:span.end] == item.title()
    kept = decontaminate(df, bench, span_limit=13).where("doc_id = 3").first()
    assert kept.clean_text == kept.text and kept.contaminated


def test_short_item_inside_a_longer_match():
    a = Automaton([(0, [b"a", b"b", b"c", b"d"]), (1, [b"c"]), (2, [b"b", b"c"])], 4)
    hit, found = a.hits(a.ids([b"z", b"b", b"c", b"z", b"c"]))
    assert hit.tolist() == [False, True, True, False, True] and found == {1, 2}
    assert np.array_equal(a.lengths(a.ids([b"a", b"b", b"x", b"b", b"c", b"d"])), [1, 2, 0, 1, 2, 3])
    assert suffix_automaton.words("Ab-É_7".encode()) == ["ab".encode(), "É".encode(), b"7"]
