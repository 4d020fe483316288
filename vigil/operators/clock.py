"""Run clocks (F3, S5): when the stages of a run began and ended, and how many rows each made."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")


class RunClock:
    """Times the actions of a run.  Row counts are observed while a stage's own action runs, so
    counting them costs no pass of its own."""

    def __init__(self, spark: SparkSession, run_id: str):
        self.spark, self.run_id, self.rows = spark, run_id, []

    def stage(self, name: str, df: DataFrame, action: Callable[[DataFrame], T]) -> T:
        """``action(df)``, which has to read ``df`` whole once."""
        seen = Observation(f"{self.run_id}-{name}-{len(self.rows)}")
        began = datetime.now(timezone.utc)
        out = action(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        ended = max(began, datetime.now(timezone.utc))  # a clock that was set back
        self.rows.append((self.run_id, len(self.rows), name, began, ended, seen.get["rows"]))
        return out

    def table(self) -> DataFrame:
        """``run_id, place, stage, began, ended, rows, elapsed`` (a day-time interval)."""
        t = self.spark.createDataFrame(
            self.rows, "run_id string, place int, stage string, began timestamp, ended timestamp, rows long")
        return t.withColumn("elapsed", F.col("ended") - F.col("began"))

    def metrics(self) -> DataFrame:
        """The long form of the metrics sink: seconds and rows of every stage."""
        seconds = F.unix_micros("ended") - F.unix_micros("began")
        wide = self.table().select("run_id", "stage", F.lit(None).cast("string").alias("class"),
                                   (seconds / 1e6).alias("seconds"), F.col("rows").cast("double").alias("rows"))
        return wide.unpivot(["run_id", "stage", "class"], ["seconds", "rows"], "metric", "value")
