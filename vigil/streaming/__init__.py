"""Streaming use of the batch operators.

The reference has no streaming behaviour; nothing new is added here.  A fitted
``PipelineModel`` transforms a streaming DataFrame unchanged, and the confusion
counts (A1) are a plain streaming aggregation, so a running evaluation table can be
kept with Structured Streaming's own state store (``complete`` output mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def score_stream(model, stream: DataFrame) -> DataFrame:
    """M10 on a stream: ``model.transform`` of a streaming DataFrame."""
    return model.transform(stream)


def running_confusion(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """A1 as a streaming aggregate: non-zero cells ``(actual, predicted, n)``; null is a class
    of its own, as in the batch counts."""
    return (scored.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def start_to_table(agg: DataFrame, checkpoint: str, table_name: str,
                   trigger_available_now: bool = True) -> StreamingQuery:
    """Run the aggregate into an in-memory table (small results, tests) with a reliable
    checkpoint folder (which must be shared storage on a cluster), processing what is
    available and stopping.  See :func:`start_to_path` for results kept on storage."""
    writer = (agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
                 .format("memory").queryName(table_name))
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_to_path(agg: DataFrame, checkpoint: str, path: str,
                  trigger_available_now: bool = True) -> StreamingQuery:
    """Keep the running aggregate as a Parquet folder on shared storage: every
    micro-batch's complete result replaces the previous one (``foreachBatch``), so no
    result passes through the driver."""
    def write(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = (agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
                 .foreachBatch(write))
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
