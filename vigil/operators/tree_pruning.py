"""Grid search over decision trees by pruning.

A greedy tree's splits depend neither on the depth limit nor on the least size of a node that
may be split; both only say where growth ends.  So one deep tree for each leaf size and fold,
cut at a depth or below a size, is the tree of every other grid point: 7 x 5 x 5 points over
five folds need 5 x 5 fits and one last one.  Spark's own pruning (siblings that predict alike
become one leaf) changes no prediction of a cut either: a class that leads in all leaves
below a node leads in the node.

Node tables are read from the saved models and walked over arrays, all cuts of a tree in one
pass; only counts of (actual, predicted) cells leave the tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.models import MAX_TREE_DEPTH, training_frame
from vigil.operators.select import best_candidate
from vigil.operators.tree_growth import Nodes, cut, grow, walk
from vigil.sources.sinks import kept, scratch_path

DEPTHS = (None, 10, 20, 25, 30, 40, 50)
LEAVES = (1, 2, 3, 4, 5)
MIN_SPLITS = (2, 3, 4, 5, 10)


class Point(NamedTuple):
    """A grid point; its place in the grid."""
    grid_pos: int
    max_depth: int
    min_leaf: int
    min_split: int


def grid(depths: Sequence[int | None] = DEPTHS, leaves: Sequence[int] = LEAVES,
         min_splits: Sequence[int] = MIN_SPLITS) -> list[Point]:
    """All points, by depth, leaf size, split size.  Spark's trees end at ``MAX_TREE_DEPTH``:
    "unlimited" and deeper limits are that one, and equal points are one."""
    depth = list(dict.fromkeys(min(d or MAX_TREE_DEPTH, MAX_TREE_DEPTH) for d in depths))
    return [Point(i, *p) for i, p in enumerate(product(depth, leaves, min_splits))]


def nodes_of(spark: SparkSession, model: DecisionTreeClassificationModel) -> Nodes:
    """The node table of a fitted tree (features without categories), from its saved form."""
    path = scratch_path(spark, "tree")
    model.write().save(path)
    t = (spark.read.parquet(f"{path}/data")
         .select("id", "prediction", "leftChild", "rightChild", "rawCount", "split.featureIndex",
                 F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
                 ((F.col("leftChild") >= 0) & (F.col("split.numCategories") >= 0)).alias("categories"))
         .orderBy("id").toArrow().to_pydict())
    if any(t["categories"]):
        raise ValueError("splits on categories have no threshold")
    inner = np.array(t["leftChild"]) >= 0
    threshold = np.array([x if ok else 0.0 for x, ok in zip(t["threshold"], inner)], float)
    return Nodes(np.where(inner, t["featureIndex"], 0), threshold, np.array(t["leftChild"]),
                 np.array(t["rightChild"]), np.array(t["prediction"], float), np.array(t["rawCount"]))


class PrunedTree(NamedTuple):
    """The searched model: a node table and how many features it reads."""
    nodes: Nodes
    point: Point

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``prediction``."""
        nodes = df.sparkSession.sparkContext.broadcast(self.nodes)

        @F.pandas_udf("double")
        def predicted(x):
            import pandas as pd
            return pd.Series(walk(nodes.value, np.stack(x.to_numpy()))[:, 0] if len(x) else [], dtype=float)

        return df.withColumn("prediction", predicted(vector_to_array(features)))


def _cells(points: list[Point], trees):
    """Rows (x, label, fold) -> counts of (point, fold, actual, predicted), a task's own sums.
    ``trees``: by (leaf size, fold), those that did not see the fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        by_leaf: dict[int, list[Point]] = {}
        for p in points:
            by_leaf.setdefault(p.min_leaf, []).append(p)
        for batch in batches:
            if not batch.num_rows:
                continue
            label = batch.column(1).to_numpy(zero_copy_only=False)
            fold = batch.column(2).to_numpy(zero_copy_only=False)
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            for f in np.unique(fold).tolist():
                own = fold == f
                for leaf, some in by_leaf.items():
                    found = walk(trees.value[leaf, f], x[own], [p.max_depth for p in some],
                                 [p.min_split for p in some])
                    for p, predicted in zip(some, found.T):
                        pairs, n = np.unique(np.stack((label[own], predicted)), axis=1, return_counts=True)
                        for a, b, c in zip(*pairs.tolist(), n.tolist()):
                            counts[p.grid_pos, f, a, b] += c
        rows = [(*k, n) for k, n in counts.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()))],
            names=["grid_pos", "fold", "actual", "predicted", "n"])
    return run


def macro_f1(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """A9 by group from cells ``by..., actual, predicted, n``: the mean over the union of true and
    predicted labels."""
    by = list(by)
    side = lambda c, n: cells.select(*by, F.col(c).alias("class"), F.col("n").alias(n))
    hits = cells.where("actual = predicted").select(*by, F.col("actual").alias("class"), F.col("n").alias("tp"))
    none = F.lit(0).cast("long")
    parts = [side("actual", "a").withColumn("p", none).withColumn("tp", none),
             side("predicted", "p").withColumn("a", none).withColumn("tp", none),
             hits.withColumn("a", none).withColumn("p", none)]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    sums = stacked.groupBy(*by, "class").agg(F.sum("a").alias("a"), F.sum("p").alias("p"), F.sum("tp").alias("tp"))
    # summed in order of classes, so that it does not depend on partitions
    f1 = F.transform(F.array_sort(F.collect_list(F.struct("class", (2 * F.col("tp") / (F.col("a") + F.col("p")))
                                                          .alias("f1")))), lambda s: s["f1"])
    return sums.groupBy(*by).agg((F.aggregate(f1, F.lit(0.0), lambda s, v: s + v) / F.count("class")).alias("score"))


def grid_search(train: DataFrame, label: str = "label", features: str = "features", fold: str = "fold",
                k: int = 5, points: list[Point] | None = None, parallelism: int = 5,
                seed: int = 42) -> tuple[DataFrame, PrunedTree]:
    """M5 + M6: ``grid_pos, max_depth, min_leaf, min_split, fold, score`` (macro-F1 of the rows of
    each fold, by trees that did not see it), and the best point's tree over all rows (M11).

    Rows whose fold is null are used for the last fit only.  An empty fold scores nothing."""
    spark = train.sparkSession
    points = points or grid()
    deepest = max(p.max_depth for p in points)
    rows = training_frame(kept(train.select(F.col(features).alias("features"), F.col(label).alias("label"),
                                            F.col(fold).cast("int").alias("fold")), "grid"))

    def fit(leaf: int, f: int | None, depth: int = deepest) -> Nodes:
        part = rows if f is None else rows.where(F.col("fold").isNull() | (F.col("fold") != f))
        return grow(part, "label", "features", depth, leaf, seed=seed)

    wanted = list(product(sorted({p.min_leaf for p in points}), range(k)))
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            trees = dict(zip(wanted, pool.map(lambda w: fit(*w), wanted)))
        cells = (rows.where("fold IS NOT NULL").select(vector_to_array("features").alias("x"), "label", "fold")
                 .mapInArrow(_cells(points, spark.sparkContext.broadcast(trees)),
                             "grid_pos int, fold int, actual double, predicted double, n long")
                 .groupBy("grid_pos", "fold", "actual", "predicted").agg(F.sum("n").alias("n")))
        scores = macro_f1(kept(cells, "cells"), ["grid_pos", "fold"])
        table = spark.createDataFrame(points, "grid_pos int, max_depth int, min_leaf int, min_split int")
        scores = kept(table.join(scores, "grid_pos"), "scores")
        best = points[best_candidate(scores, "grid_pos", "score", fold="fold").first()["grid_pos"]]
        last = cut(fit(best.min_leaf, None, best.max_depth), best.max_depth, best.min_split)
    finally:
        rows.unpersist()
    return scores, PrunedTree(last, best)
