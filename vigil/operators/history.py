"""Training-history analytics on a ``(run_id, epoch, accuracy, val_accuracy, val_loss)``
table (A13, W1-W3).  Histories are tiny (runs × epochs); every window is partitioned
by ``run_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def events_history(events: DataFrame) -> DataFrame:
    """A history table derived from the events stream: run = event type, epoch = day
    number from the run's first day, ``accuracy`` = mean value of the day (from integer
    cents, so every engine computes the same double), ``val_accuracy`` = events of the
    day, ``val_loss`` = whole units of the day's mean.  The per-day aggregate is a
    partial (map-side) aggregation; windows run on the aggregated rows only."""
    day = F.to_date(F.col("ts"))
    daily = (events.groupBy(F.col("event_type").alias("run_id"), day.alias("day"))
                   .agg(F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
                        F.count(F.lit(1)).alias("n")))
    first = F.min("day").over(Window.partitionBy("run_id"))
    mean = F.col("cents") / F.col("n")
    return daily.select(
        "run_id", F.datediff(F.col("day"), first).alias("epoch"),
        mean.alias("accuracy"), F.col("n").cast("double").alias("val_accuracy"),
        F.floor(mean / 100).cast("double").alias("val_loss"))


def history_flags(hist: DataFrame, patience: int) -> DataFrame:
    """Per-epoch flags: ``learned`` (accuracy above the previous epoch), ``overfit``
    (val_accuracy below the previous epoch), ``improving`` (val_loss strictly below
    every earlier epoch; the first epoch always improves), ``last_best`` and ``stop``
    (``epoch - last_best >= patience``)."""
    w = Window.partitionBy("run_id").orderBy("epoch")
    best_before = F.min("val_loss").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = hist.select(
        "*",
        (F.col("accuracy") > F.lag("accuracy").over(w)).alias("learned"),
        (F.col("val_accuracy") < F.lag("val_accuracy").over(w)).alias("overfit"),
        (best_before.isNull() | (F.col("val_loss") < best_before)).alias("improving"))
    last_best = F.max(F.when(F.col("improving"), F.col("epoch"))).over(
        w.rowsBetween(Window.unboundedPreceding, 0))
    flagged = flagged.withColumn("last_best", last_best)
    return flagged.withColumn("stop", (F.col("epoch") - F.col("last_best")) >= patience)


def history_summary(hist: DataFrame, patience: int = 3) -> DataFrame:
    """One row per run:

    * ``epochs_to_learn`` (W1): first epoch whose accuracy beats the previous one,
      counted from 1; null if none.
    * ``overfit_epoch`` (W2): first epoch whose val_accuracy falls below the previous
      one, counted from 0; null if none.
    * ``stop_epoch`` / ``best_epoch`` (W3): the early-stop epoch (null if patience is
      never exhausted) and the restored best epoch.
    * ``mean_accuracy`` (A13)."""
    f = history_flags(hist, patience)
    stop_epoch = F.min(F.when(F.col("stop"), F.col("epoch")))
    best_at_stop = F.min_by(F.col("last_best"), F.when(F.col("stop"), F.col("epoch")))
    return f.groupBy("run_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_epochs"),
        F.avg("accuracy").alias("mean_accuracy"),
        F.min(F.when(F.col("learned"), F.col("epoch") + 1)).cast("bigint").alias("epochs_to_learn"),
        F.min(F.when(F.col("overfit"), F.col("epoch"))).cast("bigint").alias("overfit_epoch"),
        stop_epoch.cast("bigint").alias("stop_epoch"),
        F.coalesce(best_at_stop, F.max(F.when(F.col("improving"), F.col("epoch")))).cast("bigint").alias("best_epoch"))
