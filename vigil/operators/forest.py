"""Forests on every prefix of the features (M7), grown together.

Spark ML's forest walks every row through every tree from the root for each level, a row and a
tree at a time, and a fit for each prefix bins the rows anew.  Here rows are binned once, into
blocks of bytes; a job for each level counts the rows of all trees of all prefixes with array
operations, and the splits of a tree are chosen from the counts that all tasks add up.

A forest is that of Spark ML with its defaults: rows drawn with repetition (a Poisson number of
times, the same for all prefixes), the square root of the number of features drawn anew for
every node, thresholds of 32 bins, Gini gain, ``max_depth`` levels, sibling leaves that predict
alike merged, mean of the trees' class shares.  Draws are keyed by seed, tree and block (or
node), so they differ from Spark's own, and a task that is run again draws the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.tree_growth import best_splits, thresholds_of
from vigil.sources.sinks import kept

#: rows of a block, cells of histograms (tree x node x feature x bin x class) that a task holds
BLOCK_ROWS, CELLS = 16_384, 1 << 22

#: how often a row is drawn, by 16 random bits: Poisson's distribution of mean 1
DRAWN = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)]),
                        (np.arange(1 << 16) + 0.5) / (1 << 16), side="right").astype(np.uint8)


class Shape(NamedTuple):
    thresholds: list[np.ndarray]
    n_bins: int
    classes: int
    trees: int
    max_depth: int
    seed: int
    draws: bool     # else every row once, and all features at every node (plain trees; tests)


class Trees(NamedTuple):
    """All trees of one prefix as arrays (tree, node); the children of node i are 2i + 1 and
    2i + 2.  A leaf has feature -1."""
    features: int       # of the prefix
    feature: np.ndarray
    last: np.ndarray    # bins up to this go left
    counts: np.ndarray  # (tree, node, class)
    open: np.ndarray


def _blocks(s: Shape):
    """Rows (x, y) -> blocks of bins (feature x row: byte) and classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, number, held = len(s.thresholds), TaskContext.get().partitionId() << 32, []

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal number
            x, y = map(np.concatenate, zip(*held))
            held.clear()
            for at in range(0, len(y), BLOCK_ROWS):
                part, own = x[at:at + BLOCK_ROWS], y[at:at + BLOCK_ROWS].astype(np.int32)
                bins = np.stack([np.searchsorted(t, part[:, f]) for f, t in enumerate(s.thresholds)]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([bins.tobytes()], pa.binary()),
                                                  pa.array([own.tobytes()], pa.binary())], names=["block", "bins", "y"])
                number += 1

        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).flatten().to_numpy().reshape(-1, d), batch.column(1).to_numpy()))
            if sum(len(y) for _, y in held) >= 4 * BLOCK_ROWS:
                yield from out()
        if held:
            yield from out()
    return run


def _read(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for block, bins, y in zip(*batch.columns):
            yield (block.as_py(), np.frombuffer(bins.as_buffer(), np.uint8).reshape(d, -1),
                   np.frombuffer(y.as_buffer(), np.int32))


def _reached(bins: np.ndarray, n: int, rows: np.ndarray, feature: np.ndarray, last: np.ndarray, depth: int) -> np.ndarray:
    """The node at ``depth`` that rows come to in one tree (``bins``: feature x row, flat); below a
    leaf it is the leftmost."""
    at = np.zeros(len(rows), np.int64)
    offset, last = np.maximum(feature, 0) * n, np.where(feature < 0, 256, last)
    for _ in range(depth):
        right = bins[offset[at] + rows] > last[at]
        at += at
        at += 1
        at += right
    return at


def subset(s: Shape, features: int, tree: int, node: int) -> np.ndarray:
    """The features that a node may split by."""
    if not s.draws:
        return np.arange(features)
    some = math.ceil(math.sqrt(features))
    return np.sort(np.random.default_rng([s.seed, features, tree, node]).permutation(features)[:some])


def drawn(s: Shape, tree: int, block: int, n: int) -> np.ndarray:
    """How often a tree draws each row of a block."""
    if not s.draws:
        return np.ones(n, np.uint8)
    return DRAWN[np.random.default_rng([s.seed, tree, block]).integers(0, 1 << 16, n, np.uint16)]


def _level(t: Trees, s: Shape, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """By tree: the open nodes of a level, and the features that each may split by."""
    nodes = np.arange((1 << depth) - 1, (2 << depth) - 1)
    width = len(subset(s, t.features, 0, 0))
    out = []
    for i in range(s.trees):
        own = nodes[t.open[i, nodes]]
        out.append((own, np.array([subset(s, t.features, i, v) for v in own], np.int64).reshape(-1, width)))
    return out


def _counted(state, depth: int):
    """Blocks -> the histograms (node, feature, bin, class) of all trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, forests = state.value
        levels = [_level(t, s, depth) for t in forests]
        cells = s.n_bins * s.classes
        total = [[np.zeros(sub.size * cells) for _, sub in level] for level in levels]
        slots = []
        for level in levels:
            slots.append([])
            for own, sub in level:
                slot = np.full((2 << depth) - 1, -1)
                slot[own] = np.arange(len(own))
                slots[-1].append(slot)
        for block, bins, y in _read(batches, len(s.thresholds)):
            n = bins.shape[1]
            code, bins = (bins.astype(np.int64) * s.classes + y).ravel(), bins.ravel()
            for i in range(s.trees):
                times = drawn(s, i, block, n)
                some = np.flatnonzero(times)
                weight = times[some].astype(float)
                for t, level, slot, sums in zip(forests, levels, slots, total):
                    own, sub = level[i]
                    if not len(own):
                        continue
                    at = slot[i][_reached(bins, n, some, t.feature[i], t.last[i], depth)]
                    rows, w = some, weight
                    if len(own) < 1 << depth:   # some rows have reached a leaf
                        there = at >= 0
                        at, rows, w = at[there], rows[there], w[there]
                    for j in range(sub.shape[1]):
                        cell = code[(sub[:, j] * n)[at] + rows]
                        cell += ((np.arange(len(own)) * sub.shape[1] + j) * cells)[at]
                        sums[i] += np.bincount(cell, weights=w, minlength=sums[i].size)
        for f, sums in enumerate(total):
            some = [i for i, c in enumerate(sums) if c.size]
            if some:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f] * len(some), pa.int32()), pa.array(some, pa.int32()),
                     pa.array([sums[i].astype(np.int64).tobytes() for i in some], pa.binary())],
                    names=["forest", "tree", "counts"])
    return run


def _chosen(state):
    """The histograms of a tree's level -> the splits of its nodes."""
    def run(part: pa.Table) -> pa.Table:
        s, forests = state.value
        f, i = part.column("forest")[0].as_py(), part.column("tree")[0].as_py()
        hist = np.sum([np.frombuffer(raw.as_buffer(), np.int64) for raw in part.column("counts")], axis=0)
        width = len(subset(s, forests[f].features, 0, 0))
        hist = np.moveaxis(hist.reshape(-1, width, s.n_bins, s.classes), 3, 0)
        feature, last, left = best_splits(hist, 1)
        counts = hist[:, :, 0].sum(axis=2).T
        return pa.table({"forest": pa.array([f], pa.int32()), "tree": pa.array([i], pa.int32()),
                         "feature": [feature.astype(np.int32)], "last": [last.astype(np.int32)],
                         "left": [left.ravel()], "counts": [counts.ravel()]}).cast(
            pa.schema([("forest", pa.int32()), ("tree", pa.int32()), ("feature", pa.list_(pa.int32())),
                       ("last", pa.list_(pa.int32())), ("left", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]))
    return run


CHOSEN_DDL = "forest int, tree int, feature array<int>, last array<int>, left array<long>, counts array<long>"


def _grow(blocks: DataFrame, s: Shape, prefixes: Sequence[int]) -> list[Trees]:
    """The forests of some prefixes, a job for each level."""
    sc = blocks.sparkSession.sparkContext
    nodes = (2 << s.max_depth) - 1
    forests = [Trees(p, np.full((s.trees, nodes), -1), np.zeros((s.trees, nodes), np.int64),
                     np.zeros((s.trees, nodes, s.classes), np.int64), np.zeros((s.trees, nodes), bool)) for p in prefixes]
    for t in forests:
        t.open[:, 0] = True
    for depth in range(s.max_depth):
        if not any(t.open.any() for t in forests):
            break
        state = sc.broadcast((s, forests))
        found = (blocks.mapInArrow(_counted(state, depth), "forest int, tree int, counts binary")
                 .groupBy("forest", "tree").applyInArrow(_chosen(state), CHOSEN_DDL).collect())
        levels = [_level(t, s, depth) for t in forests]
        for t in forests:
            t.open[:] = False
        for r in found:
            t, i = forests[r["forest"]], r["tree"]
            own, sub = levels[r["forest"]][i]
            left, counts = (np.array(r[c]).reshape(len(own), s.classes) for c in ("left", "counts"))
            t.counts[i, own] = counts
            split = np.array(r["feature"]) >= 0
            at = own[split]
            t.feature[i, at] = sub[split, np.array(r["feature"])[split]]
            t.last[i, at] = np.array(r["last"])[split]
            for child, side in ((2 * at + 1, left[split]), (2 * at + 2, (counts - left)[split])):
                t.counts[i, child] = side
                t.open[i, child] = np.count_nonzero(side, axis=1) > 1
        state.destroy()
    return [_merged(t) for t in forests]


def _merged(t: Trees) -> Trees:
    """Sibling leaves that predict alike made one leaf, from the last level up."""
    feature, guess = t.feature.copy(), t.counts.argmax(axis=2)
    for node in reversed(range(feature.shape[1] // 2)):
        a, b = 2 * node + 1, 2 * node + 2
        alike = (feature[:, node] >= 0) & (feature[:, a] < 0) & (feature[:, b] < 0) & (guess[:, a] == guess[:, b])
        feature[alike, node] = -1
    return t._replace(feature=feature)


def leaf_shares(t: Trees, max_depth: int) -> np.ndarray:
    """Class shares (tree, node of the last level, class): a leaf's stand at its leftmost one."""
    share = t.counts / np.maximum(t.counts.sum(axis=2, keepdims=True), 1)
    nodes = (1 << max_depth) - 1 + np.arange(1 << max_depth)
    out = share[:, nodes].copy()
    for node in reversed(range((1 << max_depth) - 1)):
        bottom = node
        while bottom < (1 << max_depth) - 1:
            bottom = 2 * bottom + 1
        leaf = t.feature[:, node] < 0
        out[leaf, bottom - nodes[0]] = share[leaf, node]
    return out


def votes(t: Trees, share: np.ndarray, bins: np.ndarray, max_depth: int) -> np.ndarray:
    """Sums over trees of the class shares of rows (``bins``: feature x row)."""
    n = bins.shape[1]
    flat, rows, out = bins.ravel(), np.arange(n), np.zeros((n, share.shape[2]))
    for i in range(len(share)):
        out += share[i][_reached(flat, n, rows, t.feature[i], t.last[i], max_depth) - ((1 << max_depth) - 1)]
    return out


def _hits(state):
    """Blocks -> rows and hits of each forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, forests = state.value
        shares = [leaf_shares(t, s.max_depth) for t in forests]
        n, hits = 0, [0] * len(forests)
        for _, bins, y in _read(batches, len(s.thresholds)):
            n += len(y)
            for f, (t, share) in enumerate(zip(forests, shares)):
                hits[f] += int((votes(t, share, bins, s.max_depth).argmax(axis=1) == y).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([hits], pa.list_(pa.int64()))],
                                         names=["n", "hits"])
    return run


def prefix_accuracies(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, trees: int = 100,
                      seed: int = 42, max_depth: int = 5, max_bins: int = 32, draws: bool = True) -> dict[int, float]:
    """Accuracy on ``test`` of a forest on each of ``features[:1]``, ``features[:2]`` and so on.  Labels
    are class numbers from 0; a null or broken label or feature is an error, as is an empty ``train``."""
    sc = train.sparkSession.sparkContext

    def plain(df: DataFrame) -> DataFrame:
        return df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
                         F.col(label).cast("double").alias("y"))

    y = F.col("y")
    fine = F.coalesce((y >= 0) & (y == F.floor(y)), F.lit(False)) & F.forall(
        "x", lambda v: v.isNotNull() & ~F.isnan(v))
    told = [plain(df).agg(F.count(F.lit(1)), F.max("y"), F.count_if(~fine)).first() for df in (train, test)]
    n, most, _ = told[0]
    if not n or any(t[2] for t in told):
        raise ValueError("a forest needs rows, labels that are class numbers from 0, and numbers as features")
    wanted = max(max_bins * max_bins, 10_000)
    seen = plain(train).select("x") if n <= wanted else plain(train).select("x").sample(wanted / n, seed)
    values = seen.toArrow().column(0).combine_chunks().flatten().to_numpy().reshape(-1, len(features))
    thresholds = [thresholds_of(values[:, f], min(max_bins, n)) for f in range(len(features))]
    s = Shape(thresholds, max(2, 1 + max(map(len, thresholds))), max(int(most) + 1, 2), trees, max_depth, seed, draws)

    def held(df: DataFrame) -> DataFrame:
        return kept(plain(df).mapInArrow(_blocks(s), "block long, bins binary, y binary"), "forest-rows").repartition(
            2 * sc.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)

    rows, check = held(train), held(test)
    one = lambda p: trees * len(subset(s, p, 0, 0)) * s.n_bins * s.classes << max(0, max_depth - 1)
    groups: list[list[int]] = []
    for p in range(1, len(features) + 1):
        if not groups or sum(map(one, groups[-1])) + one(p) > CELLS:
            groups.append([])
        groups[-1].append(p)
    out = {}
    try:
        for prefixes in groups:
            forests = _grow(rows, s, prefixes)
            state = sc.broadcast((s, forests))
            found = check.mapInArrow(_hits(state), "n long, hits array<long>").collect()
            state.destroy()
            total = sum(r["n"] for r in found)
            for i, p in enumerate(prefixes):
                out[p] = sum(r["hits"][i] for r in found) / total if total else float("nan")
    finally:
        rows.unpersist()
        check.unpersist()
    return out
