"""Consistent placement by a permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table (an offset and a
step, both from md5 of its name).  Shards take turns; each claims its first unclaimed
preferred slot, until the table is full.  The table has a fixed size, so it is broadcast,
and placing a row is one hash and one lookup.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.llm.store import boxed

#: slots of the default table (a prime well above 100 times the default shard count)
TABLE_SIZE = 8191
SHARDS = 64
#: slots a table may have: it is broadcast
MAX_SLOTS = 1_000_003


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index into ``shards``.  Bounded by ``size``, which does not grow with data."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and differ")
    if not len(shards) <= size <= MAX_SLOTS or size < 2 or any(
            size % p == 0 for p in range(2, int(size ** 0.5) + 1)):
        raise ValueError(f"the table size must be a prime of {len(shards)} to {MAX_SLOTS}")
    steps = [(_number(f"offset|{s}") % size, _number(f"step|{s}") % (size - 1) + 1)
             for s in shards]
    place, nxt, left = [-1] * size, [o for o, _ in steps], size
    while left:
        for k, (_, step) in enumerate(steps):
            slot = nxt[k]
            while place[slot] >= 0:
                slot = (slot + step) % size
            place[slot], nxt[k] = k, (slot + step) % size
            left -= 1
            if not left:
                break
    return place


def table_frame(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """The filled table as ``slot, shard`` rows, unfolded from one literal."""
    literal = F.lit(",".join(map(str, fill_table(shards, size))))
    names = F.split(F.lit("\n".join(shards)), "\n")
    return (spark.range(1, numPartitions=1)
            .select(F.posexplode(F.split(literal, ",")).alias("slot", "k"))
            .select("slot", F.element_at(names, F.col("k").cast("int") + 1).alias("shard")))


def slot_of(key: Column, size: int) -> Column:
    """Slot of a string key: the leading 60 bits of its md5, modulo the table size.
    A null key has slot 0's hash of the empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(key, F.lit("")).cast("binary")), 1, 15),
                  16, 10).cast("long") % F.lit(size)


def place(df: DataFrame, key_cols: list[str], shards: list[str], size: int = TABLE_SIZE,
          *, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``df`` with the slot and shard of every row; no shuffle.

    The key is the ``key_cols`` as strings joined by ``|`` (a null column counts as the
    empty string).  Rows with equal keys go to one shard: give a column that differs (as
    the document id) where one key may hold much of the data.  Columns of ``df`` named as
    ``slot`` or ``shard`` are replaced.  An empty table stays empty; repeated rows are placed
    alike.
    """
    key = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
                             for c in key_cols])
    box, own = boxed(df, {slot.lower(), shard.lower()})
    table = table_frame(df.sparkSession, shards, size).select(
        F.col("slot").alias("__slot"), F.col("shard").alias("__shard"))
    return (df.select(box, slot_of(key, size).cast("int").alias("__at"))
            .join(F.broadcast(table), F.col("__at") == F.col("__slot"), "left")
            .select(*own, F.col("__at").alias(slot), F.col("__shard").alias(shard)))


def write_shards(df: DataFrame, path: str, *, shard: str = "shard",
                 files_per_shard: int = 4, salt_cols: list[str] | None = None) -> None:
    """Placed rows written to one folder per shard.  Rows of a shard are dealt over
    ``files_per_shard`` tasks by a hash of ``salt_cols`` (default: all other columns of
    simple type), so a shard that holds much of the data is not one task."""
    cols = salt_cols or [c for c, t in df.dtypes if c != shard and "<" not in t]
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(files_per_shard))
    n = df.select(shard).distinct().count() * files_per_shard
    (df.withColumn("__salt", salt).repartition(max(1, n), shard, "__salt").drop("__salt")
     .write.partitionBy(shard).parquet(path))
