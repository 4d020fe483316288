"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.session import checkpoint_dir, shuffles_dropped


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path under ``spark.checkpoint.dir`` (nothing is created yet)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/vigil-llm-{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts lineage, and a
    lost executor re-reads the files instead of recomputing what led to them.  The shuffles
    that led to them go at once."""
    return Scratch().keep(df, name)


class Scratch:
    """Intermediate tables of one run, deleted once what they led to is written."""

    def __init__(self):
        self._paths: list[tuple[SparkSession, str]] = []
        self._of: dict[int, str] = {}   # by the frame that reads a table

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """As ``keep``; the table goes with ``drop`` or ``release``."""
        spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
        self._paths.append((spark, path))
        with shuffles_dropped(spark):
            df.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        self._of[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that ``keep`` gave; no frame that still reads one may be used afterwards."""
        gone = {self._of.pop(id(t)) for t in tables}
        self._delete([x for x in self._paths if x[1] in gone])
        self._paths = [x for x in self._paths if x[1] not in gone]

    def release(self) -> None:
        """Deletes the tables; no frame that still reads one may be used afterwards."""
        self._delete(self._paths)
        self._paths.clear()
        self._of.clear()

    @staticmethod
    def _delete(paths: list[tuple[SparkSession, str]]) -> None:
        for spark, path in paths:
            sc = spark.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def boxed(df: DataFrame, added: set[str]) -> tuple[Column, list[Column]]:
    """All columns of ``df`` as one struct ``__row``, and the columns that take them out of it
    again.  Columns named as one that the operator adds (in any case) are left out: the added
    one replaces them; inside the struct no name can clash with the operator's own."""
    names = [c for c in df.columns if c.lower() not in added]
    box = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(True))
    return box.alias("__row"), [F.col(f"__row.`{c}`").alias(c) for c in names]
