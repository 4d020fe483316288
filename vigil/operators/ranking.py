"""Exact cut-offs and global row numbers without a single-partition sort (W4 and the rank
step of R2-R8).

Most uses of a rank only ask on which side of a cut a row lies.  ``hash_cuts`` counts rows
by hash bucket, finds the bucket that holds each cut, ranks the keys of those buckets alone,
and compares every row with the resulting bounds: rows are labelled in place, and nothing but
keys is ever shuffled.  ``ordered_row_ids`` is for where every row's number is wanted: rows
are range-partitioned and written once, and a row's number is its file's offset and its
place in the file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.scalar import keyed_u32
from vigil.session import checkpoint_dir


def default_bucket_bits(df: DataFrame) -> int:
    """About 16 hash buckets per shuffle partition, between 2^8 and 2^20."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, min(20, (parts * 16 - 1).bit_length()))


def hash_cuts(df: DataFrame, key_cols: Sequence[str], cuts: Callable[[Column], Sequence[Column]],
              seed=42, partition_cols: Sequence[str] = (), out: str = "passed",
              total_out: str | None = None, bucket_bits: int | None = None,
              keys_from: DataFrame | None = None) -> DataFrame:
    """``df`` with the number of cuts that each row is at or beyond.

    Rows stand in ``md5(seed|key)`` order (ties by key) within each stratum of
    ``partition_cols``; ``cuts(n)`` gives 0-based ranks, ascending, as expressions of the
    stratum's size and columns, and a row of rank ``r`` passes those ``<= r``.  Keys must be
    unique within a stratum.  ``total_out`` adds the stratum's size.  Bounds are computed from
    ``keys_from`` where given: the same rows before columns were added to them.
    """
    bits = bucket_bits or default_bucket_bits(df)
    pcols, keys = list(partition_cols), list(key_cols)
    at = F.struct(keyed_u32(seed, *keys).alias("h"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    slim = (keys_from if keys_from is not None else df).select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(pcols)],
                                                               at.alias("__at"))
    strata = [f"__s{i}" for i in range(len(pcols))]
    slim = slim.withColumn("__b", F.shiftright(F.col("__at.h"), 32 - bits))
    counts = slim.groupBy(*strata, "__b").agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(*strata)
    before = whole.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*strata, "__b", "__n",
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
                            F.sum("__n").over(whole).alias("__total"))
    named = offsets.select("*", *[F.col(s).alias(c) for s, c in zip(strata, pcols)])
    wanted = named.select(*strata, "__b", "__n", "__off", "__total",
                          F.posexplode(F.array(*[c.cast("bigint") for c in cuts(F.col("__total"))])
                                       ).alias("__i", "__cut"))
    wanted = wanted.withColumn("__r", F.greatest("__cut", F.lit(0)) - F.col("__off")).where(
        (F.col("__r") >= 0) & (F.col("__r") < F.col("__n")))

    def matches(prefix: str) -> Column:
        cond = F.lit(True)
        for s in strata:
            cond = cond & F.col(s).eqNullSafe(F.col(f"{prefix}{s}"))
        return cond

    places = wanted.select(*[F.col(s).alias(f"__w{s}") for s in strata], F.col("__b").alias("__wb"),
                           "__i", "__r")
    if not strata:
        places = F.broadcast(places)  # a row for each cut
    hit = slim.join(places.select(*[c for c in places.columns if c not in ("__i", "__r")]).distinct()
                    if strata else F.broadcast(places.select("__wb").distinct()),
                    matches("__w") & (F.col("__b") == F.col("__wb")), "left_semi")
    ranked = hit.withColumn("__rank", F.row_number().over(
        Window.partitionBy(*strata, "__b").orderBy("__at")) - 1)
    bounds = ranked.join(places, matches("__w") & (F.col("__b") == F.col("__wb"))
                         & (F.col("__rank") == F.col("__r")))
    limits = (bounds.groupBy(*strata).agg(F.map_from_entries(F.collect_list(
        F.struct("__i", "__at"))).alias("__limits")))
    totals = offsets.select(*strata, "__total").distinct()
    table = totals.select(*[F.col(s).alias(f"__t{s}") for s in strata], "__total")
    limits = limits.select(*[F.col(s).alias(f"__l{s}") for s in strata], "__limits")

    keyed = df.select("*", *[F.col(c).alias(s) for s, c in zip(strata, pcols)])
    if strata:  # a row for each stratum: Spark broadcasts it by its bytes, or splits hot strata
        joined = keyed.join(table, matches("__t"), "left").join(limits, matches("__l"), "left")
    else:
        joined = keyed.crossJoin(F.broadcast(table)).crossJoin(F.broadcast(limits))  # one row each
    passed = F.aggregate(F.map_values("__limits"), F.lit(0),
                         lambda n, bound: n + F.when(F.col("__row") >= bound, 1).otherwise(0))
    res = joined.withColumn("__row", at).withColumn(
        out, F.when(F.col("__limits").isNull(), F.lit(0)).otherwise(passed))
    if total_out:
        res = res.withColumn(total_out, F.col("__total").cast("bigint"))
    return res.drop("__row", "__limits", "__total", *strata, *[f"__t{s}" for s in strata],
                    *[f"__l{s}" for s in strata])


def ordered_row_ids(df: DataFrame, order_cols: str | Sequence[str], out: str = "row_id",
                    total_out: str | None = None) -> DataFrame:
    """Dense 0-based row ids in the order of one or more columns of any ordered type
    (unique together; nulls first).

    Rows are range-partitioned by Spark (a sample of keys sets the bounds), sorted, and
    written to the shared folder, which fixes their places: an id is the number of rows in
    the files before and the row's index in its file."""
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/vigil-ids-{uuid.uuid4().hex}"
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    rows = back.select("*", F.col("_metadata.file_name").alias("__file"),
                       F.col("_metadata.row_index").alias("__index"))
    files = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"),
                                       F.min(F.struct(*order)).alias("__first"))
    # a row for each file written: as many as Spark made partitions
    before = Window.orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(F.col("__file").alias("__f"),
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
                          F.sum("__n").over(Window.partitionBy()).alias("__total"))
    res = rows.join(F.broadcast(starts), F.col("__file") == F.col("__f"))
    res = res.withColumn(out, (F.col("__start") + F.col("__index")).cast("bigint"))
    if total_out:
        res = res.withColumn(total_out, F.col("__total").cast("bigint"))
    return res.drop("__file", "__index", "__f", "__start", "__total")


def value_at_rank(df: DataFrame, col: str, rank: Callable[[int], int], buckets: int = 4096,
                  few: int = 100_000) -> tuple[object, int]:
    """The value of ``col`` (number, date or timestamp, unique) at 0-based rank
    ``rank(n)`` of ``n`` rows, and ``n``; None if there is no such row.

    Each pass counts rows over ``buckets`` equal ranges of the interval that holds the rank
    and keeps one of them, until few rows are left, which are sorted exactly."""
    key = monotone_number(df, col)
    rows = df.select(F.col(col).alias("v"), key.alias("k"))
    n, nulls, lo, hi = rows.agg(F.count(F.lit(1)), F.count_if(F.col("v").isNull()), F.min("k"),
                                F.max("k")).first()
    want = rank(n)
    if not 0 <= want < n:
        return None, n
    want -= nulls  # nulls stand first
    if want < 0:
        return None, n
    rows, left = rows.where("v IS NOT NULL"), n - nulls
    while left > few and hi > lo:
        width = (hi - lo) / buckets
        cell = F.least(F.floor((F.col("k") - F.lit(lo)) / F.lit(width)), F.lit(buckets - 1))
        counts = sorted((r["c"], r["n"], r["a"], r["b"]) for r in rows.groupBy(cell.alias("c")).agg(
            F.count(F.lit(1)).alias("n"), F.min("k").alias("a"), F.max("k").alias("b")).collect())
        for _, count, a, b in counts:
            if want < count:
                rows, left = rows.where((F.col("k") >= F.lit(a)) & (F.col("k") <= F.lit(b))), count
                lo, hi = a, b
                break
            want -= count
    found = rows.orderBy("v").offset(want).limit(1).collect()
    return (found[0]["v"] if found else None), n


def monotone_number(df: DataFrame, col: str) -> Column:
    """A double that never decreases as ``col`` increases."""
    dtype = dict(df.dtypes)[col]
    c = F.col(col)
    if dtype == "date":
        return F.unix_date(c).cast("double")
    if dtype == "timestamp":
        return F.unix_micros(c).cast("double")
    if dtype == "timestamp_ntz":
        tz = df.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")
        if tz not in ("UTC", "GMT", "Etc/UTC", "Z", "+00:00"):
            raise ValueError("timestamp_ntz order keys need a UTC session time zone")
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        return c.cast("double")
    raise ValueError(f"a numeric, date or timestamp key is needed, not {dtype}")
