"""Evaluation tables (A1-A14, D3 helpers).

The scored rows feed exactly one aggregation, ``groupBy(actual, predicted).count()``
(partially aggregated before the shuffle): the non-zero cells of the confusion matrix.
Per-class numbers come from a linear chain on those cells: each cell adds to its row class
and its column class (``explode`` + ``groupBy(class)``).  Totals and averages over the
classes are one-row aggregates joined back, so no task ever holds all classes.

A null label or prediction is a class of its own (the null class), everywhere: a missing
prediction is a miss of the true class, in A1-A9 as in the streaming counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.scalar import safe_div

def _beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """The columns of a one-row aggregate next to every row."""
    return df.crossJoin(F.broadcast(one_row))


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Non-zero cells ``(actual, predicted, n)``; null is a class of its own."""
    return (df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
              .agg(F.count(F.lit(1)).alias("n")))


def _labels(counts: DataFrame, labels: Sequence | None) -> DataFrame:
    """One column ``label``: the union of true and predicted labels, or the given list."""
    if labels is not None:
        dtype = dict(counts.dtypes)["actual"]
        return counts.sparkSession.createDataFrame([(x,) for x in labels], f"label {dtype}")
    return counts.select(F.explode(F.array("actual", "predicted")).alias("label")).distinct()


def confusion_matrix(df: DataFrame, actual: str, predicted: str,
                     labels: Sequence | None = None) -> DataFrame:
    """A1: long-form confusion matrix ``(actual, predicted, n)`` over the union of true and
    predicted labels (or the given ``labels``), zero cells included: the k x k grid, which
    is the result's size, joined to the non-zero cells."""
    counts = confusion_counts(df, actual, predicted)
    names = _labels(counts, labels)
    # the list of k labels as one row beside each label, unfolded to the grid
    row = names.agg(F.collect_list(F.struct("label")).alias("all"))
    grid = (_beside(names, row).select(F.col("label").alias("actual"), F.explode("all").alias("p"))
            .select("actual", F.col("p.label").alias("predicted")))
    cells = counts.select(F.col("actual").alias("__a"), F.col("predicted").alias("__p"), "n")
    return (grid.join(cells, F.col("actual").eqNullSafe(F.col("__a"))
                      & F.col("predicted").eqNullSafe(F.col("__p")), "left")
            .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def _per_class(df: DataFrame, actual: str, predicted: str, labels: Sequence | None = None) -> DataFrame:
    """k rows ``(class, tp, support, predicted_n, in_l)`` over the union of true
    and predicted labels (plus given ``labels`` absent from both, with zeros).  ``in_l``
    marks the given labels, or the classes with support when none are given."""
    counts = confusion_counts(df, actual, predicted)
    zero = F.lit(0).cast("bigint")
    parts = counts.select(F.explode(F.array(
        F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"), zero.alias("predicted_n"),
                 F.when(F.col("actual").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(zero).alias("tp")),
        F.struct(F.col("predicted").alias("cls"), zero.alias("support"), F.col("n").alias("predicted_n"),
                 zero.alias("tp")))).alias("c")).select("c.*")
    per = parts.groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                   F.sum("predicted_n").alias("predicted_n"))
    if labels is None:
        per = per.withColumn("in_l", F.col("support") > 0)
    else:
        keep = _labels(counts, labels).withColumn("in_l", F.lit(True))
        per = per.join(keep, F.col("cls").eqNullSafe(F.col("label")), "full_outer").select(
            F.coalesce("cls", "label").alias("cls"),
            *[F.coalesce(F.col(c), zero).alias(c) for c in ("tp", "support", "predicted_n")],
            F.coalesce(F.col("in_l"), F.lit(False)).alias("in_l"))
    return per.withColumnRenamed("cls", "class")


def class_counts(df: DataFrame, actual: str, predicted: str, labels: Sequence | None = None) -> DataFrame:
    """A2/A4: per class ``tp, fp, fn, tn, support, predicted_n``: diagonal, column and
    row sums and the total of the matrix (counted over all rows, as a per-label
    confusion matrix does even when ``labels`` is a subset)."""
    per = _per_class(df, actual, predicted, labels)
    per = _beside(per, per.agg(F.coalesce(F.sum("support"), F.lit(0)).alias("total")))
    if labels is not None:
        per = per.where(F.col("in_l"))
    return per.select(
        "class", "tp", (F.col("predicted_n") - F.col("tp")).alias("fp"),
        (F.col("support") - F.col("tp")).alias("fn"),
        (F.col("total") - F.col("support") - F.col("predicted_n") + F.col("tp")).alias("tn"),
        "support", "predicted_n")


def class_rates(df: DataFrame, actual: str, predicted: str, labels: Sequence | None = None) -> DataFrame:
    """A1→A3: ``(class, tp, fp, fn, tn, fpr, fnr)``; a zero denominator gives 0."""
    c = class_counts(df, actual, predicted, labels)
    return c.select("class", "tp", "fp", "fn", "tn",
                    safe_div(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"),
                    safe_div(F.col("fn"), F.col("fn") + F.col("tp")).alias("fnr"))


PRF = ("precision", "recall", "f1")


def _prf(tp: Column, fp: Column, fn: Column):
    p = safe_div(tp, tp + fp)
    r = safe_div(tp, tp + fn)
    f = safe_div(2 * p * r, p + r)
    return p, r, f


def _scored(per: DataFrame) -> DataFrame:
    fp = F.col("predicted_n") - F.col("tp")
    fn = F.col("support") - F.col("tp")
    p, r, f = _prf(F.col("tp"), fp, fn)
    return per.select(F.col("class").cast("string").alias("class"), p.alias("precision"),
                      r.alias("recall"), f.alias("f1"), "support", "tp", fp.alias("fp"),
                      fn.alias("fn"), "predicted_n", "in_l")


def classification_report(df: DataFrame, actual: str, predicted: str,
                          labels: Sequence | None = None) -> DataFrame:
    """``(class, precision, recall, f1, support)`` for each label present in
    ``actual`` (or the given labels), then ``accuracy`` (or ``micro avg`` when some
    true or predicted class is not among the labels), ``macro avg`` and ``weighted avg``.
    Zero division gives 0.  The accuracy row carries only ``f1`` and ``support``."""
    scored = _scored(_per_class(df, actual, predicted, labels))
    own = scored.where("in_l")
    mean = {c: F.coalesce(F.avg(F.when(F.col("in_l"), F.col(c))), F.lit(0.0)) for c in PRF}
    wavg = {c: F.sum(F.when(F.col("in_l"), F.col(c) * F.col("support"))) for c in PRF}
    one = scored.agg(
        *[F.sum(F.when(F.col("in_l"), F.col(c))).alias(f"n_{c}") for c in ("tp", "fp", "fn", "support")],
        F.coalesce(F.sum(F.when(~F.col("in_l"), F.col("predicted_n") + F.col("support"))),
                   F.lit(0)).alias("outside"),
        *[m.alias(f"mean_{c}") for c, m in mean.items()], *[w.alias(f"sum_{c}") for c, w in wavg.items()])
    p, r, f = _prf(F.col("n_tp"), F.col("n_fp"), F.col("n_fn"))
    covers = F.col("outside") == 0

    def row(name: Column, *prf: Column) -> Column:
        return F.struct(name.alias("class"), *[c.cast("double").alias(n) for n, c in zip(PRF, prf)],
                        F.coalesce("n_support", F.lit(0)).cast("bigint").alias("support"))

    summary = one.select(F.explode(F.array(
        row(F.when(covers, "accuracy").otherwise("micro avg"), F.when(~covers, p), F.when(~covers, r), f),
        row(F.lit("macro avg"), *[F.col(f"mean_{c}") for c in PRF]),
        row(F.lit("weighted avg"), *[safe_div(F.col(f"sum_{c}"), F.col("n_support")) for c in PRF])
    )).alias("r")).select("r.*")
    return own.select("class", *PRF, F.col("support").cast("bigint").alias("support")).unionByName(summary)


def f1_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """A5/A8/A9 in one row: ``accuracy``, ``f1_micro``, ``f1_macro``, ``f1_weighted``
    over the union of true and predicted labels (zero division → 0)."""
    s = _scored(_per_class(df, actual, predicted))
    return s.agg(
        safe_div(F.sum("tp"), F.sum("support")).alias("accuracy"),
        safe_div(2 * F.sum("tp"), 2 * F.sum("tp") + F.sum("fp") + F.sum("fn")).alias("f1_micro"),
        F.avg("f1").alias("f1_macro"),
        safe_div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"))


def per_class_accuracy(df: DataFrame, actual: str, predicted: str, classes: Sequence[str]) -> DataFrame:
    """``(class, total, correct, accuracy)`` for a fixed class list; a class with
    no rows gets zeros (guarded division).  One grouped pass, conditional sums."""
    agg = (df.groupBy(F.col(actual).alias("class"))
             .agg(F.count(F.lit(1)).alias("total"),
                  F.sum(F.col(actual).eqNullSafe(F.col(predicted)).cast("long")).alias("correct")))
    spark = df.sparkSession
    fixed = spark.createDataFrame([(c,) for c in classes], f"class {dict(agg.dtypes)['class']}")
    out = fixed.join(agg, "class", "left")
    total = F.coalesce(F.col("total"), F.lit(0)).cast("bigint")
    correct = F.coalesce(F.col("correct"), F.lit(0)).cast("bigint")
    return out.select("class", total.alias("total"), correct.alias("correct"),
                      safe_div(correct, total).alias("accuracy"))


def grouped_accuracy(df: DataFrame, actual: str, predicted: str,
                     groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """A6 variant: rows grouped by which name list holds the *raw* true label, a hit is
    equality of the raw names; labels outside every list are not counted."""
    spark = df.sparkSession
    dim = spark.createDataFrame([(g, n) for g, names in groups.items() for n in names],
                                "group string, name string")
    scored = df.join(F.broadcast(dim.withColumnRenamed("name", "__g_name")),
                     F.col(actual) == F.col("__g_name"), "inner")
    agg = scored.groupBy("group").agg(F.count(F.lit(1)).alias("total"),
                                      F.sum(F.col(actual).eqNullSafe(F.col(predicted)).cast("long")).alias("correct"))
    fixed = spark.createDataFrame([(g,) for g in groups], "group string")
    out = fixed.join(agg, "group", "left")
    total = F.coalesce(F.col("total"), F.lit(0)).cast("bigint")
    correct = F.coalesce(F.col("correct"), F.lit(0)).cast("bigint")
    return out.select(F.col("group").alias("class"), total.alias("total"), correct.alias("correct"),
                      safe_div(correct, total).alias("accuracy"))


def class_weights(df: DataFrame, label: str, overrides: Mapping | None = None,
                  multipliers: Mapping | None = None) -> DataFrame:
    """``(label, n, weight, adjusted)`` with the balanced weight
    ``n_total / (k · n_label)``; ``overrides`` replace and ``multipliers`` scale it."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    counts = _beside(counts, counts.agg(F.sum("n").alias("__total"), F.count(F.lit(1)).alias("__k")))
    w = F.col("__total").cast("double") / (F.col("__k") * F.col("n")).cast("double")
    adjusted = F.col("weight")
    if overrides:
        m = F.create_map(*[x for kv in overrides.items() for x in (F.lit(kv[0]), F.lit(float(kv[1])))])
        adjusted = F.coalesce(F.try_element_at(m, F.col("label")), adjusted)
    if multipliers:
        m = F.create_map(*[x for kv in multipliers.items() for x in (F.lit(kv[0]), F.lit(float(kv[1])))])
        adjusted = adjusted * F.coalesce(F.try_element_at(m, F.col("label")), F.lit(1.0))
    return counts.withColumn("weight", w).withColumn("adjusted", adjusted).drop("__total", "__k")


def with_class_weight(df: DataFrame, label: str, weights: DataFrame, out: str = "weight",
                      col: str = "adjusted") -> DataFrame:
    """Attach the weight table as a ``weightCol`` (one row per class); Spark broadcasts it by
    its measured bytes or else shuffles."""
    w = weights.select(F.col("label").alias("__wl"), F.col(col).alias(out))
    return df.join(w, F.col(label) == F.col("__wl"), "left").drop("__wl")


EPSILON = 1e-7


def binary_log_loss(label: str | Column, prob: str | Column) -> Column:
    """A12 (binary): mean cross-entropy of a 0/1 label against ``P(y=1)``; the
    probability is clipped to [eps, 1-eps] and eps is added inside the logs."""
    y = F.col(label) if isinstance(label, str) else label
    p = F.col(prob) if isinstance(prob, str) else prob
    pc = F.least(F.greatest(p.cast("double"), F.lit(EPSILON)), F.lit(1 - EPSILON))
    ll = y * F.log(pc + F.lit(EPSILON)) + (F.lit(1) - y) * F.log(F.lit(1.0) - pc + F.lit(EPSILON))
    return -F.avg(ll)


def sparse_log_loss(label: str | Column, probs: str | Column) -> Column:
    """A12 (sparse categorical): mean of ``-log(p[label])`` after normalising the row
    to sum 1 and clipping to [eps, 1-eps]."""
    y = F.col(label) if isinstance(label, str) else label
    p = F.col(probs) if isinstance(probs, str) else probs
    total = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    py = F.element_at(p, y.cast("int") + 1).cast("double") / total
    pc = F.least(F.greatest(py, F.lit(EPSILON)), F.lit(1 - EPSILON))
    return -F.avg(F.log(pc))


def count_fraction(df: DataFrame, fraction: float) -> DataFrame:
    """``n`` and ``floor(n·fraction)`` in one row."""
    return df.agg(F.count(F.lit(1)).alias("n")).withColumn(
        "n_fraction", F.floor(F.col("n") * F.lit(fraction)).cast("bigint"))
