"""Attaching separately computed predictions to their rows.

Inside a model pipeline predictions stay on their rows (``model.transform``), so no
join is needed.  When they arrive as a separate table they are attached by key: an
equi-join that Spark broadcasts by measured bytes, or else shuffles on the key and splits
where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def attach_predictions(df: DataFrame, preds: DataFrame, left_keys: list[str], right_keys: list[str],
                       how: str = "left") -> DataFrame:
    """Every row of ``df`` with the prediction columns of ``preds`` whose keys match
    (``right_keys`` must be unique in ``preds``; a row without a match keeps nulls)."""
    renamed = preds.select(*[F.col(r).alias(f"__k{i}") for i, r in enumerate(right_keys)],
                           *[c for c in preds.columns if c not in right_keys])
    cond = None
    for i, l in enumerate(left_keys):
        c = F.col(l) == F.col(f"__k{i}")
        cond = c if cond is None else cond & c
    return df.join(renamed, cond, how).drop(*[f"__k{i}" for i in range(len(right_keys))])


def with_positions(df: DataFrame, out: str = "position", total_out: str | None = None) -> DataFrame:
    """``df``, read from files and not yet filtered, with each row's 0-based place: the rows of the
    files before (by name), and the row's index in its file.  One pass counts rows by file; the
    window runs over a row for each file, and these rows are broadcast: a join by file would put
    all rows of a file into one task."""
    rows = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    files = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(F.col("__file").alias("__f"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
                          F.sum("__n").over(Window.partitionBy()).alias("__total"))
    placed = rows.join(F.broadcast(starts), F.col("__file") == F.col("__f")).withColumn(
        out, (F.col("__start") + F.col("__index")).cast("bigint"))
    if total_out:
        placed = placed.withColumn(total_out, F.col("__total").cast("bigint"))
    return placed.drop("__file", "__index", "__f", "__start", "__total")


def attach_by_position(df: DataFrame, other: DataFrame, out: str = "position") -> DataFrame:
    """J1 as it stands: every row of ``df`` with the columns of the row of ``other`` at the same
    place (nulls beyond its end); both are read from files, in whatever parts.  Places are unique
    keys, so the join's shuffle is even.  Column names must differ."""
    right = with_positions(other, "__place")
    return with_positions(df, out).join(right, F.col(out) == F.col("__place"), "left").drop("__place")


def tail_by_position(df: DataFrame, fraction: float = 0.2, out: str = "split") -> DataFrame:
    """R7 in file order: the last rows are ``val``, from row ``floor(n * (1 - fraction))`` on."""
    placed = with_positions(df, "__place", "__rows")
    val = F.col("__place") >= F.floor(F.col("__rows") * F.lit(1.0 - fraction))
    return placed.withColumn(out, F.when(val, "val").otherwise("train")).drop("__place", "__rows")
