"""Keyed splits, folds and label noise.

Randomness is a keyed md5 hash of the row key, never ``rand()`` or ``randomSplit``:
the same rows land in the same split regardless of partitioning, retries or engine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.scalar import TWO_32, keyed_u32
from vigil.operators.ranking import hash_cuts, value_at_rank


def hash_threshold(fraction: float) -> int:
    """The u32 cut-off for an expected fraction, e.g. 0.2 -> 858993459."""
    return int(fraction * TWO_32)


def hash_split(df: DataFrame, key_cols: list[str], test_fraction: float = 0.2, seed=42,
               exact: bool = False, out: str = "split") -> DataFrame:
    """Label every row ``train`` or ``test``.

    ``exact=False``: a row is test when its keyed hash is below ``fraction·2^32`` (one
    pass, no shuffle, expected size).  ``exact=True``: the ``ceil(fraction·n)`` rows
    first in hash order are test (the library size rule), by comparison with one bound."""
    if not exact:
        is_test = keyed_u32(seed, *key_cols) < F.lit(hash_threshold(test_fraction))
        return df.withColumn(out, F.when(is_test, "test").otherwise("train"))
    cut = hash_cuts(df, key_cols, lambda n: [F.ceil(F.lit(test_fraction) * n)], seed, out="__p")
    return cut.withColumn(out, F.when(F.col("__p") == 0, "test").otherwise("train")).drop("__p")


def stratified_split(df: DataFrame, key_cols: list[str], label_col: str,
                     test_fraction: float = 0.2, seed=42, out: str = "split",
                     apportion: str = "per_label") -> DataFrame:
    """Per label, the first rows in hash order are test.

    ``apportion="per_label"``: ``ceil(fraction·n_label)`` test rows per label.
    ``apportion="total"``: the total is fixed first (``n_test = ceil(fraction·n)``) and
    the training rows are apportioned by largest remainder, ``floor(n_train·n_label/n)``
    plus one for the labels with the largest remainders (ties by label order, not at
    random); each label's test part is the rest."""
    if apportion == "per_label":
        def cuts(n: Column) -> list[Column]:
            return [F.ceil(F.lit(test_fraction) * n)]
    elif apportion == "total":
        tests = total_first(df, label_col, test_fraction)
        df = (df.join(tests, F.col(label_col).eqNullSafe(F.col("__label")), "left").drop("__label"))
        cut = hash_cuts(df, key_cols, lambda n: [F.col("__tests")], seed, partition_cols=[label_col, "__tests"], out="__p")
        return cut.withColumn(out, F.when(F.col("__p") == 0, "test").otherwise("train")).drop("__p", "__tests")
    else:
        raise ValueError(apportion)
    cut = hash_cuts(df, key_cols, cuts, seed, partition_cols=[label_col], out="__p")
    return cut.withColumn(out, F.when(F.col("__p") == 0, "test").otherwise("train")).drop("__p")


def total_first(df: DataFrame, label_col: str, test_fraction: float) -> DataFrame:
    """``__label, __tests``: test rows of each label by largest remainder of its training rows.
    Windows over the table of labels only."""
    sizes = df.groupBy(F.col(label_col).alias("__label")).agg(F.count(F.lit(1)).alias("__c"))
    every = Window.partitionBy()
    n = F.sum("__c").over(every)
    sizes = sizes.withColumn("__n", n).withColumn(
        "__train", F.col("__n") - F.ceil(F.lit(test_fraction) * F.col("__n")))
    # products of counts may pass 64 bits
    share = F.col("__train").cast("decimal(19,0)") * F.col("__c").cast("decimal(19,0)")
    sizes = sizes.withColumn("__base", F.expr(
        "cast(__train as decimal(19,0)) * cast(__c as decimal(19,0)) div cast(__n as decimal(19,0))"))
    sizes = sizes.withColumn("__rem", share - F.col("__base").cast("decimal(19,0)") * F.col("__n").cast("decimal(19,0)"))
    place = F.row_number().over(Window.orderBy(F.desc("__rem"), F.col("__label").asc_nulls_first()))
    rest = F.col("__train") - F.sum("__base").over(every)
    return sizes.select("__label", "__c", "__base", place.alias("__i"), rest.alias("__rest")).select(
        "__label", (F.col("__c") - F.col("__base") - F.when(F.col("__i") <= F.col("__rest"), 1).otherwise(0))
        .cast("long").alias("__tests"))


def _fold_starts(k: int):
    """Ranks at which folds 1..k-1 start; the first ``n % k`` folds get one extra row."""
    def cuts(n: Column) -> list[Column]:
        q = F.floor(n / F.lit(k))
        return [q * i + F.least(n % F.lit(k), F.lit(i)) for i in range(1, k)]
    return cuts


def kfold(df: DataFrame, key_cols: list[str], k: int = 5, seed=42, out: str = "fold") -> DataFrame:
    """Shuffled k-fold.  Rows in hash order are cut into k contiguous folds; the
    first ``n % k`` folds get one extra row (sizes differ by at most one)."""
    return hash_cuts(df, key_cols, _fold_starts(k), seed, out=out)


def stratified_kfold(df: DataFrame, key_cols: list[str], label_col: str, k: int = 5, seed=42,
                     out: str = "fold", keys_from: DataFrame | None = None) -> DataFrame:
    """Each label's rows in hash order are cut into k contiguous folds, so every fold
    holds ``floor`` or ``ceil`` of ``n_label / k`` rows of each label."""
    return hash_cuts(df, key_cols, _fold_starts(k), seed, partition_cols=[label_col], out=out,
                     keys_from=keys_from)


def tail_holdout(df: DataFrame, order_col: str, fraction: float = 0.2, out: str = "split") -> DataFrame:
    """The last ``fraction`` of rows in ``order_col`` order (unique; nulls first) is
    ``val``; the cut is ``floor(n·(1-fraction))`` as in a training loop's validation split.
    One bound is found by counting; rows are labelled in place."""
    bound, _ = value_at_rank(df, order_col, lambda n: math.floor(n * (1.0 - fraction)))
    val = F.lit(False) if bound is None else F.coalesce(F.col(order_col) >= F.lit(bound), F.lit(False))
    return df.withColumn(out, F.when(val, "val").otherwise("train"))


def flip_labels(df: DataFrame, col: str, key_cols: list[str], fraction: float, seed=0,
                out: str | None = None, partition_cols: list[str] = ()) -> DataFrame:
    """Flip exactly ``floor(n·fraction)`` rows of a 0/1 column (``1 - x``), chosen
    without replacement in keyed-hash order.  With ``partition_cols`` the count is per
    stratum (the balanced variant)."""
    cut = hash_cuts(df, key_cols, lambda n: [F.floor(n * F.lit(fraction))], seed,
                    partition_cols=list(partition_cols), out="__p")
    flipped = F.when(F.col("__p") == 0, F.lit(1) - F.col(col)).otherwise(F.col(col)).cast("int")
    return cut.withColumn(out or col, flipped).drop("__p")


def by_row_range(row_id: str | Column, first_n, inside: Column, outside: Column) -> Column:
    """``inside`` for rows ``0 .. first_n-1`` and ``outside`` for the rest."""
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.when(rid < F.lit(first_n), inside).otherwise(outside)


def row_range(df: DataFrame, row_id: str, start, end=None) -> DataFrame:
    """Inclusive slice ``start <= row_id <= end`` (open end when ``end`` is None)."""
    cond = F.col(row_id) >= F.lit(start)
    if end is not None:
        cond = cond & (F.col(row_id) <= F.lit(end))
    return df.filter(cond)
