"""Parquet table access for the driver tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


#: session setting: spread every scan over at least this many partitions
MIN_SCAN_PARTITIONS_CONF = "vigil.minScanPartitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Column pruning and filters reach the Parquet scan because
    every query selects by name and filters with native expressions.

    A Parquet file is split at row-group boundaries only, so a small file written as one
    row group is read by one task and everything fused with the scan (hashing, scoring,
    model fits) runs on one core.  Setting ``vigil.minScanPartitions`` adds a
    round-robin repartition after the scan (pruning and filters still go below it).
    Leave it unset on large inputs: there the scan already has enough splits and the
    repartition would be a needless shuffle."""
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(MIN_SCAN_PARTITIONS_CONF, None)
    if n and int(n) > 1:
        df = df.repartition(int(n))
    return df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views under the table names, for ``spark.sql``."""
    for name in DRIVER_TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
