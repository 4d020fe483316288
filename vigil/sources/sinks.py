"""Sinks and persistence."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import checkpoint_dir


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/vigil-out/{what}-{uuid.uuid4().hex}"


def kept(df: DataFrame, what: str = "kept") -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              compression: str | None = None, rows_per_file: int = 0) -> None:
    """CSV with a header line (optional) and no index column, one file per partition.  A
    compressed file is read by one task: ``rows_per_file`` bounds it (0: no bound)."""
    out = (df.write.mode(mode).option("header", header).option("maxRecordsPerFile", rows_per_file)
           .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"))
    if compression:
        out = out.option("compression", compression)
    out.csv(path)


def run_id(*parts) -> str:
    """A deterministic run id from hyper-parameters, e.g. ``0.25-0.001_0.001-100``:
    ``run_id(0.25, (0.001, 0.001), 100)`` (tuples are joined by ``_``)."""
    def one(p):
        return "_".join(str(x) for x in p) if isinstance(p, (tuple, list)) else str(p)
    return "-".join(one(p) for p in parts)


def metrics_long(df: DataFrame, key: str, metrics: Sequence[str], run: str, stage: str) -> DataFrame:
    """A wide metrics table → ``(run_id, stage, class, metric, value)`` (``unpivot``)."""
    cast = df.select(F.col(key).cast("string").alias("class"),
                     *[F.col(m).cast("double").alias(m) for m in metrics])
    long = cast.unpivot(["class"], list(metrics), "metric", "value")
    return long.select(F.lit(run).alias("run_id"), F.lit(stage).alias("stage"), "class", "metric", "value")


def append_metrics(long: DataFrame, path: str) -> None:
    """S5 re-aimed: append the long metrics table, one folder per run."""
    long.write.mode("append").partitionBy("run_id").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (encoders and model together)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
