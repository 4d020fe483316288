"""Jaccard join, vector search, chat formatting, archives and the pipeline."""

import gzip
import hashlib
import io
import random
import re
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF001, SF01
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vigil.llm import arc_convert, jaccard_join, prefix_forest, turn_tree

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# --- Jaccard join --------------------------------------------------------------------


def word_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) >= 5:
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def brute_components(rows, percent=75):
    """(id, set size, smallest id reachable) of each row; ids must differ."""
    sets = {i: word_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    by_shingle = defaultdict(list)
    for i, s in sets.items():
        both = Counter(j for g in s for j in by_shingle[g])
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for g in s:
            by_shingle[g].append(i)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def edited(rng, words, rate):
    return [w if rng.random() > rate else rng.choice("xyz") + str(rng.randrange(10**6)) for w in words]


def near_copies(seed, groups=25, copies=6):
    """Groups of near copies around the threshold, short and long, and shared passages."""
    rng = random.Random(seed)
    new = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    passage, texts = new(60), []
    for _ in range(groups):
        base = new(rng.choice([3, 5, 7, 9, 12, 20, 40, 90, 200, 500, 1500]))
        for _ in range(copies):
            texts.append(" ".join(edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06]))))
            at = rng.randrange(len(base) + 1)
            texts.append(" ".join(base[:at] + new(rng.randrange(1, 4)) + base[at:]))
    for _ in range(60):
        n = rng.randrange(20, 120)
        texts.append(" ".join(new(n) + passage + new(n)))
    texts += texts[:5] + ["", "  \n", None, "One", "one", "one two three four", "ONE Two three four"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, small_group", [(1, 16), (2, 2), (3, 5)])
def test_jaccard_join_equals_brute_force(spark, seed, small_group):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cls", F.lit("clash"))
    got = sorted(tuple(r) for r in jaccard_join.join(df, small_group=small_group).collect())
    assert got == brute_components(rows)


def test_jaccard_chain_is_kept(spark):
    """A chain in which only neighbours are similar is one component, although the first
    and the last have little in common."""
    words = [f"w{i}" for i in range(400)]
    rows = [(100 - k, " ".join(words[8 * k:8 * k + 100])) for k in range(20)]
    got = sorted(tuple(r) for r in jaccard_join.join(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_components(rows) and {r[2] for r in got} == {81}


def test_jaccard_query_against_brute_force(spark):
    from vigil.llm.queries import op3_jaccard
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in op3_jaccard(spark, SF001).collect()) == brute_components(rows)


def test_jaccard_edges(spark):
    rows = [(None, "a b c d e f"), (5, "A b c d e f"), (5, "other words stand here now"), (5, None),
            (None, "p q r s t u"), (None, "p q r s t u"), (2, "x"), (2, "x"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_join.join(df).collect())
    assert got == Counter([(None, 2, 5), (5, 2, 5), (5, 1, 5), (5, 0, 5), (None, 2, None),
                           (None, 2, None), (2, 1, 2), (2, 1, 2), (None, 0, None)])
    assert jaccard_join.join(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.randoms(use_true_random=False))
def test_signatures_meet(size, rng):
    """Any two sets within the bound share a key asked for by the smaller one."""
    limits = jaccard_join.bands(75)
    base = np.array([rng.getrandbits(64) for _ in range(size)], np.uint64)
    n_out = rng.randrange(0, max(1, size // 7 + 1))
    n_in = rng.randrange(0, max(1, size // 7 + 1))
    other = np.concatenate((base[n_out:], np.array([rng.getrandbits(64) for _ in range(n_in)],
                                                   np.uint64)))
    a, b = np.unique(base), np.unique(other)
    both = len(np.intersect1d(a, b))
    if 100 * both < 75 * (len(a) + len(b) - both) or not len(b):
        return
    small, large = sorted((a, b), key=len)
    hot = np.array([rng.choice([0, 0, 5, 90]) for _ in small])
    ask = jaccard_join.signatures(small, jaccard_join.mix(small), hot, limits, 75, 1)
    have = jaccard_join.signatures(large, jaccard_join.mix(large), None, limits, 75, 1)
    asked = {int(k): int(f) for k, f in zip(ask[0], ask[1]) if f & jaccard_join.PROBE}
    index = have[0][have[1] & jaccard_join.INDEX > 0]
    meets = sum(2 if asked[k] & jaccard_join.TWICE else 1 for k in set(index.tolist()) & set(asked))
    assert meets
    own = bisect_right(limits.first, len(small)) == bisect_right(limits.first, len(large))
    least = jaccard_join.least_meetings(np.array([len(small)]), np.array([len(large)]),
                                        np.array([ask[2][0 if own else 1]]), 75, limits)
    assert meets >= least[0]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (7, 8), (8, 7), (5, 5), *((100 + i, 101 + i) for i in range(40))]
    got = {r.node: r.root for r in jaccard_join.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 7: 7, 8: 7, **{100 + i: 100 for i in range(41)}}


def test_jaccard_groups_travel_in_bounded_rows(spark):
    """A signature of 10,000 classes is found by one task and leaves it in bounded rows."""
    n = 10_000
    block = b"".join((np.uint32(n).tobytes(), np.arange(n, dtype=np.uint64).tobytes(),
                      np.full(n, 50, np.uint32).tobytes(), np.zeros(2 * n, np.uint16).tobytes(),
                      np.arange(2 * n, dtype=np.uint32).tobytes(), np.ones(n, np.uint32).tobytes(),
                      np.full(n, 7, np.uint32).tobytes(), np.full(n, 3, np.uint8).tobytes()))
    found = spark.createDataFrame([(0, None, None, None, None, block)], jaccard_join.BLOCKS_DDL).mapInArrow(
        jaccard_join._match(75, 16), jaccard_join.FOUND_DDL)
    rows = found.where(F.col("kind") == jaccard_join.GROUP).select("other", "members").collect()
    assert max(len(r.members) for r in rows) <= 4096 and len({r.other for r in rows}) == 1
    assert sorted(m.cls for r in rows for m in r.members) == list(range(n))


def random_sets(rng, n, universe, base):
    """Variants of a few bases, so that some are similar, as sorted hashes."""
    kinds = [[rng.randrange(universe) for _ in range(base)] for _ in range(4)]
    out = []
    for _ in range(n):
        own = set(rng.choice(kinds)[:rng.randrange(base // 2, base + 1)])
        out.append(np.array(sorted(own | {rng.randrange(universe) for _ in range(rng.randrange(3))}), np.uint64))
    return out


def similar(a, b, percent=75):
    both = len(np.intersect1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


@pytest.mark.parametrize("few, table", [(2, 40), (8, 8_000_000), (3, 700)])
def test_intersections_equal_brute_force(monkeypatch, few, table):
    monkeypatch.setattr(jaccard_join, "FEW_SETS", few)
    monkeypatch.setattr(jaccard_join, "TABLE", table)
    own = random_sets(random.Random(few), 40, 60, 25) + [np.empty(0, np.uint64)]
    left, right = np.arange(0, 41, 2), np.arange(1, 41, 2)
    for p, q in ((left, right), (np.arange(41), np.arange(41))):
        got = jaccard_join.intersections(own, p, q)
        for i, a in enumerate(p):
            for j, b in enumerate(q):
                assert a == b or got[i, j] == len(np.intersect1d(own[a], own[b]))


def test_jaccard_tiles_are_bounded_and_join_all_components(spark):
    """Any two classes of like size meet in a tile, none holds much more than two slabs, and
    what tiles return joins the components that links join, in fewer rows than components."""
    rng, rows = random.Random(6), []
    sets = random_sets(rng, 300, 400, 90)
    for c, own in enumerate(sets):
        rows.append((1, c, len(own), c // 2, own.tobytes()))
    rows += [(2, 700 + c, len(sets[c]), 700 + c, sets[c].tobytes()) for c in range(8)]
    classes = spark.createDataFrame(rows, "x long, cls long, size long, root long, own binary")
    tile = defaultdict(list)
    for r in jaccard_join.tiles(classes, 75, 32).collect():
        tile[r[:5]].append(r)
    assert max(map(len, tile.values())) <= 32 * 4  # hashing is uneven
    assert len([k for k in tile if k[0] == 2]) == 1
    edges = [(r.a, r.b) for r in jaccard_join.between_components(classes, 75, 32).collect()]
    want = [(a[3], b[3]) for a in rows for b in rows if a[0] == b[0] and a[3] < b[3]
            and similar(np.frombuffer(a[4], np.uint64), np.frombuffer(b[4], np.uint64))]
    whole = jaccard_join.spanning(want)
    assert len(edges) <= len(whole) * len(tile)
    assert len(jaccard_join.spanning(edges)) == len(whole) == len(jaccard_join.spanning(edges + want))
    assert len(want) > 2 * len(whole)  # there was something to save
    for t in tile.values():
        assert len(jaccard_join.joined_roots([(r.side, r.root, r.own) for r in t], 75)) < len({r.root for r in t})


@pytest.mark.parametrize("seed", [0, 3])
def test_jaccard_join_by_small_tiles(spark, seed):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard_join.join(df, small_group=2, slab=4).collect())
    assert got == brute_components(rows)


# --- vector search -------------------------------------------------------------------


def brute_nearest(rows, queries, k):
    out = {}
    for q, v in queries:
        scored = sorted((-sum(float(a) * float(b) for a, b in zip(v, w)), i)
                        for i, w in rows if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_forest_recall_and_order(spark):
    from vigil.llm.queries import op6_nearest
    rows = [(r.vec_id, np.array(r.embedding, float))
            for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    got = defaultdict(list)
    for r in op6_nearest(spark, SF01).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = brute_nearest(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert set(got) == set(want)
    hits = []
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        hits.append(len({f[1] for f in found} & {w[0] for w in want[q]}) / 20)
        vec = dict(rows)
        assert all(f[2] == pytest.approx(float(vec[f[1]] @ vec[q]), abs=1e-12) for f in found)
    assert np.mean(hits) >= 0.9


def test_forest_edges(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 5) for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0]) for i in range(40)]  # ties
    odd = [(300, None), (301, []), (302, [0.0] * 6), (303, [float("nan")] * 6),
           (304, [float("inf")] + [0.0] * 5), (305, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
           (306, [1.0, 2.0]), (None, [1.0] * 6), (0, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    df = df.withColumn("block", F.lit("clash")).withColumn("score", F.lit(0))
    got = defaultdict(list)
    for r in prefix_forest.search(df, F.col("vec_id") % 20 == 0, block_rows=16).collect():
        got[r.query_id].append((r["rank"], r.vec_id))
    want = brute_nearest(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert {q: [i for _, i in sorted(f)] for q, f in got.items()} == {
        q: [i for i, _ in w] for q, w in want.items()}
    few = prefix_forest.search(df.where("vec_id < 5"), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2, 3, 4]
    assert prefix_forest.search(df.limit(0), F.col("vec_id") == 0).count() == 0


def vectors(kind, n=9000, dim=24, seed=5):
    """Evenly spread, or in clusters with lengths that differ widely."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    if kind == "clustered":
        x = rng.standard_normal((60, dim))[rng.integers(0, 60, n)] + 0.3 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x if kind == "even" else x * rng.lognormal(0, 0.8, (n, 1))


@pytest.mark.parametrize("kind, most", [("even", 1.0), ("clustered", 0.35)])
def test_forest_recall_on_many_vectors(spark, kind, most):
    x = vectors(kind)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in prefix_forest.search(df, F.col("vec_id") % 50 == 0, block_rows=4500).collect():
        got[r.query_id].add(r.vec_id)
    recalls = []
    for q in range(0, len(x), 50):
        scores = x @ x[q]
        scores[q] = -np.inf
        recalls.append(len(got[q] & set(np.argsort(-scores)[:20].tolist())) / 20)
    assert np.mean(recalls) >= 0.9 and len(got) == len(recalls)
    # how much of a block queries score, where lengths are alike
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    forest = prefix_forest.Forest(np.arange(4500), unit[:4500], 1.0)
    forest.nearest(np.arange(0, 4500, 50), unit[:4500:50], 20)
    assert forest.scored / 90 / 4500 <= most
    print(kind, np.mean(recalls), forest.scored / 90 / 4500)


def test_forest_candidates_share_the_longest_prefixes():
    x = np.random.default_rng(3).standard_normal((900, 8))
    forest = prefix_forest.Forest(np.arange(900), x, float(np.linalg.norm(x, axis=1).max()), trees=3, least=2)
    lo, hi = forest.ranges(x[:5])
    for i in range(5):
        rows = set(forest.candidates(x[i], lo[i], hi[i], 5).tolist())
        level = next(lv for lv in range(prefix_forest.BITS + 1) if rows == set().union(
            *(forest.order[t][lo[i, t, lv]:hi[i, t, lv]].tolist() for t in range(3))))
        assert len(rows) >= 10
        if level:  # one bit more of the prefix: fewer
            longer = set().union(*(forest.order[t][lo[i, t, level - 1]:hi[i, t, level - 1]].tolist() for t in range(3)))
            assert longer <= rows


class Picked(np.ndarray):
    """Counts the rows taken out of a table by number."""
    rows = 0

    def __getitem__(self, key):
        if isinstance(key, np.ndarray) and self.ndim == 2:
            Picked.rows += len(key)
        return super().__getitem__(key)


def test_forest_scores_a_candidate_once():
    """Where vectors are spread evenly, queries pick fewer rows than they score."""
    x = vectors("even", n=4000, dim=64)
    forest = prefix_forest.Forest(np.arange(4000), x, 1.0)
    forest.vectors = forest.vectors.view(Picked)
    Picked.rows = 0
    for i in range(0, 256, 64):
        forest.nearest(np.arange(i, i + 64), x[i:i + 64], 20)
    assert forest.scored > 0.5 * 256 * 4000
    assert Picked.rows < 0.5 * forest.scored


@pytest.mark.parametrize("kind", ["even", "clustered"])
def test_forest_finds_the_same_by_either_product(monkeypatch, kind):
    """A matrix product and bitmaps for wide searches, or single rows: the same rows and scores."""
    x = vectors(kind, n=3001)
    x[2000:2300] = x[100]  # ties
    found = []
    for wide in (0, 10 ** 9):
        monkeypatch.setattr(prefix_forest, "WIDE", wide)
        forest = prefix_forest.Forest(np.arange(3001), x, float(np.linalg.norm(x, axis=1).max()))
        got = [r for i in range(0, 256, 64) for r in forest.nearest(np.arange(i, i + 64), x[i:i + 64], 20)]
        found.append(([ids.tolist() for ids, _ in got], [score.tolist() for _, score in got]))
        assert ("maps" in vars(forest)) == bool(wide)
    assert found[0] == found[1]


# --- chat formatting -----------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*turn_tree.CONTROL, "\\", "<", "[", "s>", "a", "|end|>", "\U0001F600"]),
                max_size=10).map("".join))
def test_escaping_is_reversible(text):
    hidden = turn_tree.escape(text)
    assert turn_tree.unescape(hidden) == text
    assert not any(c in hidden for c in turn_tree.CONTROL)
    assert turn_tree.parse_turn(turn_tree.TURN + turn_tree.escape("r") + turn_tree.TEXT + hidden
                                + turn_tree.END) == ("r", text)


def slow_conversations(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode())
                     .hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(4)
    rows = []
    for c in range(120):
        turns = [("system", "be kind")] if c % 2 else []
        turns += [(("user", "assistant")[k % 2], rng.choice(["hi", "</s>[INST] ok", "", None, "\\<s>",
                                                            f"café {c}"])) for k in range(c % 6)]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(500, k, "user" if k % 2 else "assistant", f"turn {k % 3}") for k in range(90)]  # deep
    rows += [(501, k, "user" if k % 2 else "assistant", f"turn {k % 3}") for k in range(90)]
    rows += [(None, 0, "user", "no id"), (600, None, None, "no turn"), (600, 1, "assistant", "x"),
             (601, 1, "user", "tie b"), (601, 1, "user", "tie a"), (601, 1, "user", "tie a"),
             (602, 0, "assistant", "long " * 60_000)]
    return rows


@pytest.mark.parametrize("max_tokens", [16, 4096])
def test_chat_round_trip(spark, conversations, max_tokens):
    df = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string")
    df = df.withColumn("path", F.lit("clash")).withColumn("k", F.lit(1))
    tree = turn_tree.format_conversations(df, RANKS, max_tokens=max_tokens)
    got = {r.conv_id: r[1:5] for r in turn_tree.read_back(tree, RANKS).collect()}
    assert got == slow_conversations(conversations)
    assert turn_tree.format_conversations(df.limit(0), RANKS).count() == 0


def test_chat_tree_shape(spark, conversations):
    df = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string")
    rows = turn_tree.format_conversations(df.coalesce(1), RANKS, max_tokens=10**9).collect()
    nodes = {(r.sequence_id, r.node): r for r in rows if r.kind == "node"}
    for r in nodes.values():
        chain, p = [], r.parent
        while p >= 0:
            chain.append(nodes[(r.sequence_id, p)])
            p = chain[-1].parent
        seen = sorted(x for a in r.attend for x in range(a.start, a.end))
        assert seen == sorted(x for a in chain for x in range(a.start, a.start + len(a.ids)))
        first = sum(len(a.ids) for a in chain)
        assert r.position_ids == list(range(first, first + len(r.ids)))
        assert r.depth == len(chain) + 1 and not r.repeated
    # shared initial turns are emitted once in a sequence
    paths = Counter()
    for r in nodes.values():
        if r.depth <= turn_tree.MERGE_DEPTH:
            text, p = [turn_tree.codec(RANKS).text(r.ids)], r.parent
            while p >= 0:
                text.append(turn_tree.codec(RANKS).text(nodes[(r.sequence_id, p)].ids))
                p = nodes[(r.sequence_id, p)].parent
            paths[(r.sequence_id, tuple(text))] += 1
    assert max(paths.values()) == 1


def test_chat_shares_long_prefixes_across_tasks(spark):
    prefix = [(("user", "assistant")[k % 2], f"shared {k}") for k in range(80)]
    rows = [(c, k, r, t) for c in range(40) for k, (r, t) in enumerate(
        [*prefix[:80 - c % 3], ("user", f"own {c % 20}"), ("assistant", f"end {c % 20}")])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several tasks
    try:
        out = turn_tree.format_conversations(df, RANKS, max_tokens=10**9).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
    assert len({r.sequence_id for r in out}) > 1
    enc, nodes, unmarked, marked = turn_tree.codec(RANKS), {}, Counter(), Counter()
    for r in sorted((r for r in out if r.kind == "node"), key=lambda r: (r.sequence_id, r.row_no)):
        path = (*nodes.get((r.sequence_id, r.parent), ()), enc.text(r.ids))
        nodes[(r.sequence_id, r.node)] = path
        (marked if r.repeated else unmarked)[path] += 1
    assert max(unmarked.values()) == 1  # a turn is under the loss mask once in all sequences
    assert marked and set(marked) <= set(unmarked)
    turns = defaultdict(list)
    for c, k, role, text in rows:
        turns[c].append((role, text))
    assert len(unmarked) == len({tuple(v[:n]) for v in turns.values() for n in range(1, len(v) + 1)})


# --- archives ------------------------------------------------------------------------


def arc_bytes(version, records, end=b"\n"):
    block = f"{version} 0 test\n{arc_convert.ARC_FIELDS[version]}\n".encode()
    more = "200 - - 0 t.arc " if version == 2 else ""
    out = [f"filedesc://t.arc 0.0.0.0 20200101000000 text/plain {more}{len(block)}\n".encode() + block]
    for url, date, body in records:
        extra = "200 abc - 17 t.arc " if version == 2 else ""
        out.append(f"{url} 1.2.3.4 {date} text/html {extra}{len(body)}\n".encode() + body)
    return end.join(out) + end


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    body = b"HTTP/1.0 200 OK\r\nX-Page-Id: 7\r\n\r\nhello\nfiledesc://no WARC/1.0\r\n\xff"
    raw = arc_bytes(version, [("http://a/b c", "20010203040506", body), ("dns:x", "2001", b"1.2.3.4"),
                              ("http://e/", "bad", b"")], b"\n\n")
    for data in (raw, gzip.compress(raw), b"".join(gzip.compress(p) for p in (raw[:90], raw[90:]))):
        got = list(arc_convert.parse_arc(arc_convert._stream(data)))
        assert [(g[2], g[3]["url"], g[4]) for g in got] == [
            (version, "http://a/b c", body), (version, "dns:x", b"1.2.3.4"), (version, "http://e/", b"")]
        assert got[0][0] == "t.arc"
    assert arc_convert.split_http(body)[1].startswith(b"hello")
    assert [arc_convert.iso_date(g[3]["archive-date"]) for g in got] == [
        "2001-02-03T04:05:06Z", "2001-01-01T00:00:00Z", "1970-01-01T00:00:00Z"]


def test_archive_round_trip(spark, scratch):
    long_page = "<p>" + "same " * 400
    rows = [(1, "http://a/", long_page), (2, "http://b/ x", long_page), (3, None, long_page),
            (4, "http://c/", "short"), (5, "http://d/", "short"), (6, "http://e/", None),
            (7, "http://f/", ""), (None, "http://g/", long_page + "!"), (None, None, long_page + "!"),
            (8, "http://h/", "WARC/1.0\r\nContent-Length: 5\r\n\r\n" * 60), (9, "u\n", "x" * 999),
            (10, "v", "x" * 999), (11, "w", "é" * 500), (12, "w", "é" * 500), (2, "again", long_page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    arc_convert.write_arc(df.withColumn("payload", F.lit("clash")), f"{scratch}/arc")
    arc_convert.convert(spark, f"{scratch}/arc", f"{scratch}/warc")
    got = arc_convert.refers_to_page(arc_convert.read_warc(spark, f"{scratch}/warc")).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    assert len({r.record_id for r in got}) == len(rows)
    have = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got)
    want = Counter()
    top = {}
    for p, _, h in rows:
        top[h] = max(top.get(h, -1), -1 if p is None else p)
    for p, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 1000 and p is not None and p < top[h]
        want[(p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response",
              top[h] if again else None)] += 1
    # of two rows without an id one is the response
    null = (None, len(long_page) + 1, hashlib.sha1((long_page + "!").encode()).hexdigest())
    want[(*null, "response", None)] -= 1
    want[(*null, "revisit", None)] += 1
    assert have == want
    with gzip.open(io.BytesIO(b"")) as f:
        assert list(arc_convert.parse_warc(f)) == []


def test_arc_damage_is_flagged(spark, scratch):
    """A damaged header, a body beyond its declared length and a cut end: every byte is in a
    record or in a flagged row."""
    good = b"HTTP/1.0 200 OK\r\nX-Page-Id: 3\r\n\r\npayload"
    raw = arc_bytes(1, [("http://a/", "2001", good), ("http://lost/", "2001", b"line one\nline two"),
                        ("http://b/", "2002", good), ("http://cut/", "2003", good * 100)])
    raw = raw.replace(b"text/html 17\nline", b"text/html 1x7\nline")[:-3000]
    raw = raw.replace(good + b"\nhttp://lost", good + b"more\nhttp://lost")
    got = list(arc_convert.parse_arc(arc_convert._stream(raw)))
    assert [(g[3] and g[3]["url"], g[5]) for g in got] == [
        ("http://a/", None), (None, "skipped"), ("http://b/", None), ("http://cut/", "truncated")]
    lost = got[1][4]
    assert lost.startswith(b"more\nhttp://lost/ ") and lost.rstrip(b"\n").endswith(b"line two")
    assert raw[got[1][1]:].startswith(lost)
    (spark.createDataFrame([(raw.decode(),)], "value string").coalesce(1)
     .write.option("lineSep", " ").text(f"{scratch}/arc"))
    rows = {r.damage: r for r in arc_convert.damages(spark, f"{scratch}/arc").collect()}
    assert rows["skipped"].offset == got[1][1] and rows["skipped"].bytes == len(lost)
    assert rows["truncated"].url == "http://cut/" and rows["truncated"].archive == "t.arc"
    arc_convert.convert(spark, f"{scratch}/arc", f"{scratch}/warc")
    back = {r.url: r.intact for r in arc_convert.read_warc(spark, f"{scratch}/warc").collect()}
    assert back == {"http://a/": True, "http://b/": True, "http://cut/": False}


def test_archive_empty(spark, scratch):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    arc_convert.write_arc(none, f"{scratch}/arc")
    arc_convert.convert(spark, f"{scratch}/arc", f"{scratch}/warc")
    assert arc_convert.read_warc(spark, f"{scratch}/warc").count() == 0


# --- pipeline ------------------------------------------------------------------------


def test_pipeline_stages(spark):
    """Every stage against a plain version of what it promises, on its own input."""
    import corpus_pipeline as c
    from test_text_operators import brute_spans, check_pieces, slow_targets
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(900_001, None, "en", "s", 0), (900_002, "123 456", "en", "s", 7),
                                 (900_003, "", None, None, 0)], docs.schema)
    docs = docs.unionByName(odd)
    kept = c.identify_language(spark, docs, "").cache()
    lost = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {900_001, 900_002, 900_003} <= lost
    assert all(not any(map(str.isalpha, texts[d] or "")) for d in lost)
    assert kept.columns == docs.columns

    single = c.drop_near_duplicates(spark, kept, "").cache()
    groups = brute_components([(r.doc_id, r.text) for r in kept.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, _, g in groups if i == g)

    clean = c.redact_secrets(spark, single, "").cache()
    assert clean.count() == single.count() and clean.columns == docs.columns
    before = {r.doc_id: r.text for r in single.collect()}
    for r in clean.collect():
        out, at = [], 0
        for start, _, end, kind in brute_spans(before[r.doc_id]):
            if start >= at:
                out += [before[r.doc_id][at:start], f"[{kind}]"]
            at = max(at, end)
        assert r.text == "".join(out) + before[r.doc_id][at:]

    mixed = c.mix_sources(spark, clean, "").cache()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = Counter(), Counter()
    for r in clean.collect():
        sizes[r.source] += count(r.text)
    for r in mixed.collect():
        taken[r.source] += count(r.text)
    assert all(abs(taken[s] - t) <= 0.5 for s, t in slow_targets(sizes).items())
    assert mixed.columns == docs.columns

    check_pieces(c.pack_windows(spark, mixed, "").collect(),
                 [(r.doc_id, r.text) for r in mixed.collect()])


def test_pipeline_keeps_one_row_of_each_group(spark):
    """Null and repeated ids: rows, not ids, are kept or dropped."""
    import corpus_pipeline as c
    base = "one two three four five six seven eight nine ten eleven twelve thirteen".split()
    text = " ".join(base * 3)
    rows = [(1, text), (2, text + " more"), (2, "quite another text that stands on its own here now"),
            (None, text), (None, text), (3, "quite another text that stands on its own here now"),
            (None, "nobody else says these few words in just this order"), (4, None), (4, None), (5, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = c.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [rows[0], rows[2], rows[6], (4, None), (4, None), (5, " ")], key=repr)
    assert c.identify_language(spark, docs.withColumn("lang", F.lit(None).cast("string")), "").count() == len(rows)


def test_pipeline_on_empty_table(spark):
    import corpus_pipeline as c
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in c.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_oracles(spark):
    import oracle_harness
    from vigil.llm.queries import LLM_ORACLES, LLM_QUERIES
    con = oracle_harness.duck_connection(SF001)
    for name, sql in LLM_ORACLES.items():
        res = oracle_harness.compare(LLM_QUERIES[name](spark, SF001), con, sql)
        assert res["cols_match"] and res.get("exact"), (name, res)


def shuffle_files(spark) -> int:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_a_kept_table_leaves_no_shuffle_files(spark):
    from vigil.llm.store import Scratch
    from vigil.session import DROP_SHUFFLES_CONF
    before = spark.conf.get(DROP_SHUFFLES_CONF, None)
    scratch = Scratch()
    spark.sparkContext._jvm.System.gc()
    there = shuffle_files(spark)
    one = scratch.keep(spark.range(1000).repartition(3, "id"), "one")
    two = scratch.keep(one.groupBy((one.id % 7).alias("k")).count(), "two")
    assert shuffle_files(spark) <= there and spark.conf.get(DROP_SHUFFLES_CONF, None) == before
    assert one.count() == 1000 and two.agg({"count": "sum"}).first()[0] == 1000
    scratch.drop(one)
    assert not any("-one-" in p for _, p in scratch._paths) and two.count() == 7
    scratch.release()


def test_rows_are_shuffled_once_for_join_and_window(spark):
    from vigil.llm import curriculum
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(i, "a b c", None if i % 5 == 0 else "s", 5) for i in range(20)],
                                     "doc_id long, text string, source string, n_chars long")
        plan = curriculum.curriculum(docs, ordered=False)
        told = plan._jdf.queryExecution().executedPlan().toString()
        above, below = told.split("SortMergeJoin", 1)
        assert "__order" in above.split("Window [", 1)[1] and "Exchange" not in above and "Exchange" in below
        assert plan.count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
