"""The two-stage classification workflow, end to end.

Composition only: every step is an operator of this package, every intermediate is a
DataFrame, and nothing but model parameters and a few small tables (class lists,
dictionaries) reaches the driver.

    train = read_connections(spark, "train.csv"); test = read_connections(spark, "test.csv")
    result = run_cascade(train, test, key="record_id")
    result.metrics.show()

Order: encode, split off validation rows (R2), fit the weighted binary stage on normalised
features, score its training rows out of fold, oversample the encoded features (R1), set the
stage-1 column on the resampled rows and flip part of it (R8), normalise, fit the weighted
multi-class stage, and report loss and accuracy on the validation rows (A12).  Encoders are
fitted on training rows only; ``encode_mode="refit"`` re-fits per split as the original does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import labels as L
from vigil.operators import encode as E
from vigil.operators import metrics as M
from vigil.operators import models as ML
from vigil.operators import split as SP
from vigil.operators.resample import smote
from vigil.sources import connections as C
from vigil.sources import sinks as SK

# ---------------------------------------------------------------------------
# Default weight adjustments of the two stages (by class name).
# ---------------------------------------------------------------------------
BINARY_WEIGHT_OVERRIDES = {"attack": 1.5, "normal": 0.8}
MULTI_WEIGHT_MULTIPLIERS = {"normal": 1.4, "probe": 2.5, "r2l": 20.0}
FIVE_CLASSES = ["dos", "normal", "probe", "r2l", "u2r"]


@dataclass
class CascadeResult:
    binary_rates: DataFrame
    binary_report: DataFrame
    multi_rates: DataFrame
    multi_report: DataFrame
    class_accuracy: DataFrame
    losses: DataFrame           # stage, loss and accuracy on the validation rows (A12)
    resampled: DataFrame        # per class: rows that stage 2 is fitted on, and synthetic ones
    metrics: DataFrame          # long form (run_id, stage, class, metric, value)
    scored: DataFrame           # test rows with stage-1 and stage-2 predictions


def _encode_categoricals(train: DataFrame, test: DataFrame, cols: Sequence[str], mode: str
                         ) -> tuple[DataFrame, DataFrame]:
    for c in cols:
        if mode == "refit":               # E2: each side gets its own sorted codes
            train = E.ordinal_encode(train, c, c + "_i")
            test = E.ordinal_encode(test, c, c + "_i")
        else:                             # E1 on train; a value unseen in train gets code k
            d = E.fit_unknown_dictionary(train, c, unknown="\u0000unseen")
            train = E.encode(train, c, d, c + "_i", unseen="error")
            test = E.encode(test, c, d, c + "_i", unseen="unknown")
    return train, test


def unit(v: Column) -> Column:
    """E6 on an array column: divided by its L2 norm; zeros stay zero."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(v, lambda x: x / F.when(norm == 0, F.lit(1.0)).otherwise(norm))


def two_stage(train: DataFrame, test: DataFrame, key: str, *, features: Sequence[str],
              categorical: Sequence[str], binary: Callable[[], Column], category: Callable[[], Column],
              kept: str, classes: Sequence[str], overrides: dict, multipliers: dict,
              flip_fraction: float, smote_k: int | None, seed: int, folds: int, encode_mode: str,
              max_iter: int, validation_fraction: float, run_id: str) -> CascadeResult:
    """The workflow on any table: ``binary`` and ``category`` label its rows (``kept`` is the
    binary class of ones), ``key`` is a unique, stable row key."""
    train, test = _encode_categoricals(train, test, categorical, encode_mode)
    raw = F.array(*[F.col(c + "_i" if c in categorical else c).cast("double") for c in features])

    def labelled(df: DataFrame) -> DataFrame:
        return (df.withColumn("raw", raw).withColumn("bin", binary()).withColumn("cat", category())
                  .withColumn("y1", L.indicator("bin", kept).cast("double"))
                  .withColumn("features", array_to_vector(unit(F.col("raw"))))
                  .select(key, "raw", "bin", "cat", "y1", "features"))

    # the original's hold-out of training rows (R2), by key
    part = SP.hash_split(labelled(train), [key], validation_fraction, f"{seed}v", out="part")
    part = SK.kept(part, "part")   # written tables cut lineage where rows are used again
    fit, check, test = part.where("part = 'train'"), part.where("part = 'test'"), labelled(test)
    weights = M.class_weights(fit, "bin", overrides=overrides)
    weighted = SK.kept(M.with_class_weight(fit, "bin", weights, out="w1"), "weighted")
    est1 = LogisticRegression(featuresCol="features", labelCol="y1", weightCol="w1", maxIter=max_iter)
    stage1 = ML.without_summary(est1.fit(weighted))

    def stage1_pred(scored: DataFrame) -> DataFrame:
        p1 = vector_to_array(F.col("probability"))[1]
        return scored.withColumn("p1", p1).withColumn("stage1_pred", L.threshold(p1, 0.5)) \
                     .drop("rawPrediction", "probability", "prediction")

    test = stage1_pred(stage1.transform(test))
    test = test.withColumn("bin_pred", F.when(F.col("stage1_pred") == 1, kept).otherwise(
        next(iter(set(overrides) - {kept}), "other")))
    check = stage1_pred(stage1.transform(check))
    loss1 = check.agg(F.lit("binary").alias("stage"), M.binary_log_loss("y1", "p1").alias("loss"),
                      F.avg((F.col("stage1_pred") == F.col("y1")).cast("double")).alias("accuracy"))
    # stage 2 learns from predictions of models that never saw the row
    own = stage1_pred(ML.out_of_fold(weighted, est1, [key], folds, seed)) if folds else \
        stage1_pred(stage1.transform(weighted))
    own = SK.kept(own.select(key, "raw", "cat", "stage1_pred"), "stage1")
    if smote_k:  # on the encoded features, before they are normalised
        grown = smote(own, key, "cat", "raw", k=smote_k, seed=seed)
        s1 = own.select(F.col(key).alias("__key"), F.col("stage1_pred").alias("__own"))
        grown = grown.join(s1, F.col("source_id") == F.col("__key"), "left")
        # synthetic rows take the stage-1 column from their class (1 = kept)
        grown = grown.withColumn("stage1_pred", F.when(F.col("is_synthetic"), (F.col("cat") == kept).cast("int"))
                                 .otherwise(F.col("__own"))).drop("__key", "__own")
    else:
        grown = own.select(F.col(key).alias("source_id"), F.lit(0).cast("bigint").alias("sample"), "cat", "raw",
                           F.lit(False).alias("is_synthetic"), "stage1_pred")
    grown = SK.kept(grown, "resampled")
    resampled = grown.groupBy("cat").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(F.col("is_synthetic").cast("bigint")).alias("n_synthetic"))
    if flip_fraction > 0:  # of all resampled rows
        grown = SK.kept(SP.flip_labels(grown, "stage1_pred", ["source_id", "sample"], flip_fraction, seed=seed),
                        "flipped")
    cats = E.fit_unknown_dictionary(own, "cat")

    def second(df: DataFrame, unseen: str) -> DataFrame:
        df = E.encode(df, "cat", cats, "y2", unseen=unseen).withColumn("y2", F.col("y2").cast("double"))
        df = df.withColumn("unit", array_to_vector(unit(F.col("raw")))).withColumn(
            "stage1_in", F.col("stage1_pred").cast("double"))
        return VectorAssembler(inputCols=["unit", "stage1_in"], outputCol="features2").transform(df)

    w2 = M.class_weights(grown, "cat", multipliers=multipliers)
    est2 = LogisticRegression(featuresCol="features2", labelCol="y2", weightCol="w2", family="multinomial",
                              maxIter=max_iter)
    stage2 = ML.without_summary(est2.fit(second(M.with_class_weight(grown, "cat", w2, out="w2"), "error")))
    names = cats.label_list()

    def decoded(df: DataFrame) -> DataFrame:
        scored = stage2.transform(second(df, "unknown")).withColumn("probs", vector_to_array("probability"))
        return scored.withColumn("cat_pred", L.decode(L.argmax("probs"), names))

    scored = SK.kept(decoded(test).select(key, "bin", "bin_pred", "cat", "cat_pred", "stage1_pred"), "scored")
    seen = decoded(check).where(F.col("y2") < F.size("probs"))
    loss2 = seen.agg(F.lit("multi").alias("stage"),
                     M.sparse_log_loss(F.col("y2").cast("int"), F.col("probs")).alias("loss"),
                     F.avg((F.col("cat") == F.col("cat_pred")).cast("double")).alias("accuracy"))
    losses = SK.kept(loss1.unionByName(loss2), "losses")

    binary_rates, multi_rates = M.class_rates(scored, "bin", "bin_pred"), M.class_rates(scored, "cat", "cat_pred")
    accuracy = M.per_class_accuracy(scored, "cat", "cat_pred", classes)
    rates = ["tp", "fp", "fn", "tn", "fpr", "fnr"]
    metrics = (SK.metrics_long(binary_rates, "class", rates, run_id, "binary")
               .unionByName(SK.metrics_long(multi_rates, "class", rates, run_id, "multi"))
               .unionByName(SK.metrics_long(accuracy, "class", ["total", "correct", "accuracy"], run_id, "multi")))
    return CascadeResult(binary_rates, M.classification_report(scored, "bin", "bin_pred"), multi_rates,
                         M.classification_report(scored, "cat", "cat_pred"), accuracy, losses, resampled, metrics,
                         scored)


def with_record_key(df: DataFrame, key: str) -> DataFrame:
    """A key from the record itself: a hash of all fields, and a number among equal records
    (which are interchangeable), so it does not depend on file layout."""
    from pyspark.sql import Window
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    n = F.row_number().over(Window.partitionBy("__h").orderBy(*df.columns))
    return (df.withColumn("__h", h).withColumn(key, F.concat_ws("-", F.hex("__h"), n.cast("string")))
              .drop("__h"))


def run_cascade(train: DataFrame, test: DataFrame, *, key: str | None = None, flip_fraction: float = 0.25,
                smote_k: int | None = 5, seed: int = 42, folds: int = 5, encode_mode: str = "train",
                max_iter: int = 100, validation_fraction: float = 0.2,
                run_id: str | None = None) -> CascadeResult:
    """Connection records: binary stage (normal vs attack) -> five-way stage fed with the
    stage-1 prediction.  Without a ``key`` column the records' own hash serves."""
    features = C.feature_columns(with_difficulty="difficulty" in train.columns)
    if key is None:
        key = "record_id"
        train, test = with_record_key(train, key), with_record_key(test, key)
    return two_stage(train, test, key, features=features, categorical=C.CATEGORICAL,
                     binary=lambda: L.binary_label(C.LABEL), category=lambda: L.taxonomy_label(C.LABEL),
                     kept=L.NORMAL, classes=FIVE_CLASSES, overrides=BINARY_WEIGHT_OVERRIDES,
                     multipliers=MULTI_WEIGHT_MULTIPLIERS, flip_fraction=flip_fraction, smote_k=smote_k, seed=seed,
                     folds=folds, encode_mode=encode_mode, max_iter=max_iter,
                     validation_fraction=validation_fraction,
                     run_id=run_id or SK.run_id(flip_fraction, (max_iter,), seed))
