"""Best-candidate selectors (W6-W8).  Top-1 by ``orderBy(...).limit(1)`` plans as a
per-partition top-1 plus a merge (``TakeOrderedAndProject``), never a full sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.split import kfold


def best_candidate(results: DataFrame, candidate: str, score: str, fold: str | None = None) -> DataFrame:
    """Mean score per candidate over folds; the best mean wins, exact ties go to the
    first candidate (smallest ``candidate``, e.g. grid position).  A candidate's few fold
    scores are summed in sorted order, so its mean does not depend on partitioning."""
    scores = F.array_sort(F.collect_list(F.col(score).cast("double")))
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    means = results.groupBy(candidate).agg((total / F.count(score)).alias("score")) if fold else \
        results.select(candidate, F.col(score).alias("score"))
    return means.orderBy(F.desc("score"), F.asc(candidate)).limit(1)


def best_prefix(results: DataFrame, n_features: str, score: str) -> DataFrame:
    """Backward elimination keeps a prefix when its score is ``>=`` the best so far,
    walking from the largest prefix down: ties therefore go to the smaller prefix."""
    return results.orderBy(F.desc(score), F.asc(n_features)).limit(1)


def best_trial(trials: DataFrame, trial: str, objective: str, maximize: bool = True) -> DataFrame:
    """The single best trial of a search."""
    key = F.desc(objective) if maximize else F.asc(objective)
    return trials.orderBy(key, F.asc(trial)).limit(1)


def part_selectors(part: DataFrame, seed=42, price_cut: float = 1500.0) -> DataFrame:
    """The three selectors on search tables derived from ``part``: grid position =
    size with 5 keyed folds (W6), prefix length = size with a 2-decimal accuracy (W7),
    trial = brand with the mean price as objective (W8)."""
    hit = (F.col("p_retailprice") > price_cut).cast("double")
    folded = kfold(part, ["p_partkey"], 5, seed, out="fold")
    search = folded.groupBy(F.col("p_size").alias("grid_pos"), "fold").agg(F.avg(hit).alias("score"))
    w6 = best_candidate(search, "grid_pos", "score", fold="fold")
    elim = part.groupBy(F.col("p_size").alias("n_features")).agg(F.round(F.avg(hit), 2).alias("score"))
    w7 = best_prefix(elim, "n_features", "score")
    trials = part.groupBy(F.col("p_brand").alias("trial")).agg(F.avg("p_retailprice").alias("score"))
    w8 = best_trial(trials, "trial", "score")
    return (w6.select(F.lit("best_candidate").alias("selector"), F.col("grid_pos").cast("string").alias("candidate"), "score")
              .unionByName(w7.select(F.lit("best_prefix").alias("selector"),
                                     F.col("n_features").cast("string").alias("candidate"), "score"))
              .unionByName(w8.select(F.lit("best_trial").alias("selector"), F.col("trial").alias("candidate"), "score")))
