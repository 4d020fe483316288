"""SMOTE oversampling (R1) and the union of originals with synthetic rows.

Every class is grown to the size of the largest one.  A grown class needs more than
``k`` rows.  Instead of global random draws, each row of a grown class gets a quota
(``need // n`` plus one for the first ``need % n`` rows in keyed-hash order), and every
synthetic row ``j`` of base row ``x`` takes neighbour ``md5(seed|id|j|n) % k`` of
``x`` and gap ``u = md5(seed|id|j|u) / 2^32``: ``x + u · (neighbour − x)``.  All draws
are keyed, so the output does not depend on partitioning or retries.

A base row carries its ``k`` neighbour vectors (bounded), so synthetic rows are made
by ``explode`` without any join after it.  Quotas larger than ``chunk_rows`` are cut
into chunks that are spread over tasks before they are exploded, so one tiny class
facing a huge majority does not put billions of rows into one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.scalar import keyed_u32, keyed_uniform
from vigil.operators.neighbors import knn_within_class
from vigil.operators.ranking import hash_cuts


class ClassTooSmall(ValueError):
    pass


def class_sizes(df: DataFrame, class_col: str) -> dict:
    """Rows per class (a partial aggregate): one row per class reaches the driver, the
    class list being what resampling targets are defined over."""
    return {r[0]: r[1] for r in df.groupBy(class_col).count().collect()}


def smote(df: DataFrame, id_col: str, class_col: str, vec_col: str, k: int = 5, seed=42,
          block_rows: int | None = None, chunk_rows: int = 100_000) -> DataFrame:
    """``(source_id, sample, <class_col>, <vec_col>, is_synthetic)``: every original row
    (``sample = 0``) and the synthetic rows (``sample = 1..quota``) of each grown class."""
    # rows without a class are kept as originals but neither grown nor counted
    sizes = {c: n for c, n in class_sizes(df, class_col).items() if c is not None}
    if not sizes:
        raise ValueError("no labelled rows")
    target = max(sizes.values())
    need = {c: target - n for c, n in sizes.items() if target - n > 0}
    small = sorted(str(c) for c in need if sizes[c] <= k)
    if small:
        raise ClassTooSmall(f"classes with at most k={k} rows cannot be oversampled: {', '.join(small)}")

    base = df.select(F.col(id_col).alias("source_id"), F.col(class_col).alias("cls"),
                     F.col(vec_col).cast("array<double>").alias("vec"))
    originals = base.select("source_id", F.lit(0).cast("bigint").alias("sample"), "cls", "vec",
                            F.lit(False).alias("is_synthetic"))
    if not need:
        return originals.withColumnRenamed("cls", class_col).withColumnRenamed("vec", vec_col)

    grown_classes = list(need)
    grow = base.where(F.col("cls").isin(grown_classes))
    nn = knn_within_class(grow, "source_id", "cls", "vec", k=k, block_rows=block_rows, seed=seed,
                          vectors="nvec")
    nbrs = (nn.groupBy("source_id")
              .agg(F.sort_array(F.collect_list(F.struct("rank", "nvec"))).alias("nbrs")))

    need_map = F.create_map(*[x for c, v in need.items() for x in (F.lit(c), F.lit(v))])
    need_c = F.element_at(need_map, F.col("cls")).cast("bigint")
    cut = hash_cuts(grow, ["source_id"], lambda n: [need_c % n], seed, partition_cols=["cls"], out="__p",
                    total_out="__n")
    quota = (F.floor(need_c / F.col("__n")) + F.when(F.col("__p") == 0, 1).otherwise(0)).cast("bigint")
    based = cut.select("source_id", "cls", "vec", quota.alias("quota")).where(F.col("quota") > 0)
    based = based.join(nbrs, "source_id")

    max_quota = max(-(-need[c] // sizes[c]) for c in need)
    draws = explode_counts(based.select("source_id", "cls", "vec", "nbrs", "quota"), "quota", "sample",
                           chunk_rows, spread=max_quota > chunk_rows)
    pick = (keyed_u32(seed, "source_id", "sample", F.lit("n")) % F.size("nbrs")) + 1
    draws = draws.select("*", pick.cast("int").alias("__pick"),
                         keyed_uniform(seed, "source_id", "sample", F.lit("u")).alias("__u"))
    nbr = F.element_at(F.col("nbrs"), F.col("__pick")).getField("nvec")
    new_vec = F.zip_with(F.col("vec"), nbr, lambda a, b: a + F.col("__u") * (b - a))
    synthetic = draws.select("source_id", F.col("sample").cast("bigint").alias("sample"), "cls",
                             new_vec.alias("vec"), F.lit(True).alias("is_synthetic"))
    return (originals.unionByName(synthetic).withColumnRenamed("cls", class_col)
                     .withColumnRenamed("vec", vec_col))


def smote_summary(resampled: DataFrame, class_col: str, vec_col: str) -> DataFrame:
    """Per class: originals, synthetic rows, total, and the sum of all synthetic vector
    elements (a checksum of the generated values)."""
    elem_sum = F.aggregate(F.col(vec_col), F.lit(0.0), lambda acc, x: acc + x)
    return resampled.groupBy(class_col).agg(
        F.sum((~F.col("is_synthetic")).cast("long")).alias("n_original"),
        F.sum(F.col("is_synthetic").cast("long")).alias("n_synthetic"),
        F.count(F.lit(1)).alias("n_total"),
        F.coalesce(F.sum(F.when(F.col("is_synthetic"), elem_sum)), F.lit(0.0)).alias("synthetic_sum"))


def explode_counts(df: DataFrame, count_col: str, out: str, chunk_rows: int = 100_000,
                   spread: bool = False) -> DataFrame:
    """One row per ``1..count`` of every input row.  Counts above ``chunk_rows`` are
    first cut into chunks; with ``spread`` the chunks are hash-distributed over tasks
    before the final ``explode``, so one row with a huge count is not one task."""
    chunks = F.explode(F.sequence(F.lit(0).cast("bigint"),
                                  F.ceil(F.col(count_col) / F.lit(chunk_rows)).cast("bigint") - 1))
    chunked = df.select("*", chunks.alias("__chunk"))
    if spread:
        chunked = chunked.repartition(*[c for c in df.columns if c != count_col][:1], "__chunk")
    j = F.explode(F.sequence(F.col("__chunk") * chunk_rows + 1,
                             F.least(F.col(count_col), (F.col("__chunk") + 1) * chunk_rows)))
    return chunked.select(*df.columns, j.alias(out)).drop(count_col)


def resample_to_counts(df: DataFrame, key_cols: list[str], label_col: str, targets: Mapping,
                       seed=42, out: str = "copy", chunk_rows: int = 100_000) -> DataFrame:
    """Random over/under-sampling to per-class target counts, keyed and exact.

    A class with ``n`` rows and target ``t <= n`` keeps its first ``t`` rows in keyed-hash
    order; with ``t > n`` every row appears ``t // n`` times plus once more for the
    first ``t % n`` rows (``out`` numbers the copies from 1).  Classes without a target
    keep every row once."""
    tmap = F.create_map(*[x for k, v in targets.items() for x in (F.lit(k), F.lit(int(v)))])

    def target(n: Column) -> Column:
        return F.coalesce(F.try_element_at(tmap, F.col(label_col)).cast("bigint"), n)

    # below the cut: rows that are kept, or that are copied once more
    cut = hash_cuts(df, key_cols, lambda n: [F.when(target(n) <= n, target(n)).otherwise(target(n) % n)],
                    seed, partition_cols=[label_col], out="__p", total_out="__n")
    t, extra = target(F.col("__n")), F.when(F.col("__p") == 0, 1).otherwise(0)
    copies = F.when(t <= F.col("__n"), extra).otherwise(F.floor(t / F.col("__n")) + extra).cast("bigint")
    kept = cut.withColumn("__copies", copies).drop("__p", "__n").where(F.col("__copies") > 0)
    sizes = class_sizes(df, label_col)
    worst = max([-(-int(v) // max(1, sizes.get(k, 1))) for k, v in targets.items()] or [1])
    return explode_counts(kept, "__copies", out, chunk_rows, spread=worst > chunk_rows)
