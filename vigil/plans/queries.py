"""Registered queries on the driver tables.  Each takes ``(spark, sf_dir)`` and returns
a DataFrame whose columns match the SQL oracle of the same name in
:mod:`vigil.plans.oracle`.  Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import labels as L
from vigil.functions import scalar as S
from vigil.operators import attach as AT
from vigil.operators import encode as E
from vigil.operators import history as H
from vigil.operators import metrics as M
from vigil.operators import neighbors as NB
from vigil.operators import resample as RS
from vigil.operators import select as SEL
from vigil.operators import split as SP
from vigil.operators.clock import RunClock
from vigil.operators.ranking import ordered_row_ids
from vigil.sources import connections as CSV
from vigil.sources import sinks as SK
from vigil.sources.tables import table

R6 = 6  # decimals kept on float outputs so both engines agree on every digit

# ---------------------------------------------------------------------------
# Fixed parameters of the driver-table queries.
# ---------------------------------------------------------------------------
DOC_LENGTH_THRESHOLD = 500             # rule prediction: quality 1 when n_chars > 500
FLAG_LABELS = ["A", "N", "R"]          # lineitem return flags, code order
FLAG_CLASSES = ["A", "N", "R", "Z"]    # fixed class list; Z never occurs
EVENT_GROUPS = {"engagement": ["click", "view"], "conversion": ["purchase"]}
EVENT_KEEP = ["signup"]
SEGMENT_OVERRIDES = {"BUILDING": 1.5}
SEGMENT_MULTIPLIERS = {"MACHINERY": 2.5, "HOUSEHOLD": 1.4}
SEED = 42


def _r(c, d=R6):
    return S.round_half_away(c, d)


def _flag_rule(li: DataFrame) -> DataFrame:
    """A 4-way rule prediction of the return flag from the discount; ``U`` exists only
    on the predicted side, so the label union and the report's micro row are used."""
    pred = (F.when(F.col("l_discount") < 0.03, "A").when(F.col("l_discount") < 0.06, "N")
             .when(F.col("l_discount") < 0.09, "R").otherwise("U"))
    return li.select(F.col("l_returnflag").alias("actual"), pred.alias("predicted"))


# --- A1-A3: the minimum slice (flagship) ------------------------------------------

def confusion_rates(spark: SparkSession, sf: str) -> DataFrame:
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    scored = lab.join(docs, "doc_id").select(
        F.col("quality").cast("bigint").alias("actual"),
        (F.col("n_chars") > DOC_LENGTH_THRESHOLD).cast("bigint").alias("predicted"))
    rates = M.class_rates(scored, "actual", "predicted")
    return rates.select("class", "tp", "fp", "fn", "tn", _r(F.col("fpr")).alias("fpr"),
                        _r(F.col("fnr")).alias("fnr"))


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return M.confusion_matrix(_flag_rule(li), "actual", "predicted")


def class_report(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    rep = M.classification_report(_flag_rule(li), "actual", "predicted")
    return rep.select("class", _r(F.col("precision")).alias("precision"), _r(F.col("recall")).alias("recall"),
                      _r(F.col("f1")).alias("f1"), "support")


def report_with_label_list(spark: SparkSession, sf: str) -> DataFrame:
    """A7 with a label list that leaves out a true class: a micro row, not accuracy."""
    li = table(spark, sf, "lineitem")
    rep = M.classification_report(_flag_rule(li), "actual", "predicted", labels=["A", "N"])
    return rep.select("class", _r(F.col("precision")).alias("precision"), _r(F.col("recall")).alias("recall"),
                      _r(F.col("f1")).alias("f1"), "support")


def metrics_with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """A2/A5 on predictions attached by key where some are missing (J1): finished orders
    have none, so their lines' predictions are null, a class of its own."""
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") != "F")
    flag = (F.when(F.col("o_totalprice") < 100000.0, "A").when(F.col("o_totalprice") < 200000.0, "N")
             .otherwise("R"))
    preds = o.select("o_orderkey", flag.alias("predicted"))
    li = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("actual"))
    scored = AT.attach_predictions(li, preds, ["l_orderkey"], ["o_orderkey"])
    counts = M.class_counts(scored, "actual", "predicted")
    one = M.f1_scores(scored, "actual", "predicted").select(_r(F.col("accuracy")).alias("accuracy"))
    return counts.crossJoin(F.broadcast(one))


def brand_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """A1 over 150 classes: a part's type against that of the part 7 keys ahead."""
    p = table(spark, sf, "part").select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("actual"))
    ahead = p.select((F.col("p_partkey") - 7).alias("k"), F.col("actual").alias("predicted"))
    return M.confusion_matrix(p.join(ahead, F.col("p_partkey") == F.col("k")), "actual", "predicted")


def f1_summary(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    s = M.f1_scores(_flag_rule(li), "actual", "predicted")
    return s.select(*[_r(F.col(c)).alias(c) for c in s.columns])


def class_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    acc = M.per_class_accuracy(_flag_rule(li), "actual", "predicted", FLAG_CLASSES)
    return acc.select("class", "total", "correct", _r(F.col("accuracy")).alias("accuracy"))


# --- P5-P7, P11: relabelling ----------------------------------------------------

def binary_relabel(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return ev.select("event_id", L.binary_label("event_type", keep="view", other="other").alias("binary_type"),
                     L.indicator("event_type", "view").alias("is_view"),
                     F.col("event_type").isin("click", "purchase").cast("int").alias("in_list"))


def taxonomy_relabel(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "event_type")
    cased = ev.withColumn("category", L.taxonomy_label("event_type", EVENT_GROUPS, keep=EVENT_KEEP))
    dim = L.taxonomy_frame(spark, EVENT_GROUPS, keep=EVENT_KEEP)
    joined = L.taxonomy_join(cased, "event_type", dim, "category_join")
    return joined.select("event_id", "category", "category_join")


# --- P1-P4, P10, P14, J2, J3: projections and matrix attach/split ----------------

def feature_projection(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    li = li.where(F.col("l_returnflag") == "R")                        # P10
    feats = li.select(*li.columns[:-2])                                 # P1: all but the last two
    feats = feats.drop("l_partkey", "l_suppkey")                        # P3
    main = F.array(*[F.col(c).cast("float") for c in
                     ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]])   # P14
    extra = F.array((F.col("l_linenumber") > 3).cast("float"))
    mat = F.concat(main, extra)                                         # J2: horizontal concat
    out = feats.select("l_orderkey", "l_linenumber", mat.alias("m"))    # P4
    sliced = F.slice(F.col("m"), 1, 4)                                  # J3: main part
    return out.select(
        "l_orderkey", "l_linenumber", F.size("m").cast("bigint").alias("width"),
        *[_r(F.element_at(sliced, i + 1).cast("double")).alias(f"f{i}") for i in range(4)],
        F.element_at(F.col("m"), -1).cast("double").alias("last"))


# --- P12, P13, P15, P16, F8: scores, arg-max, decode ---------------------------

def argmax_decode(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    scores = F.array(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity") / F.lit(500.0))
    code = L.argmax(scores)
    labels = F.array(*[F.lit(x) for x in FLAG_LABELS])
    return li.select(
        "l_orderkey", "l_linenumber", code.alias("code"),
        L.decode(code, FLAG_LABELS).alias("predicted"),
        L.hit("l_returnflag", L.decode(code, FLAG_LABELS)).alias("hit"),
        L.threshold(F.col("l_discount") * 10, 0.5).alias("above"),
        S.index_of(labels, F.col("l_returnflag")).alias("flag_pos"))


# --- E1, E2, E9, W5: ordinal codes ----------------------------------------------

def ordinal_encode(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    d = E.fit_dictionary(o, "o_orderpriority")
    coded = E.encode(o, "o_orderpriority", d, "priority_code")
    split = SP.hash_split(coded, ["o_orderkey"], 0.2, SEED)
    per_split = E.ordinal_encode(split, "o_orderstatus", "status_code", strata=["split"])
    return per_split.select("o_orderkey", "priority_code", "split", "status_code",
                            F.lit(d.size).cast("bigint").alias("n_classes"))


def encode_customer_names(spark: SparkSession, sf: str) -> DataFrame:
    """E1 on a column of long values with a common head."""
    c = table(spark, sf, "customer").select("c_custkey", F.concat(
        F.lit("https://example.org/customers/by-name/"), F.col("c_name")).alias("name"))
    return E.ordinal_encode(c, "name", "name_code").select("c_custkey", "name_code")


def encode_split_orders(spark: SparkSession, sf: str) -> DataFrame:
    """E2 per split on a key of more than 10,000 values, and E1 on dates."""
    li = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    split = SP.hash_split(li, ["o_orderkey"], 0.2, SEED)
    coded = E.ordinal_encode(split, "o_orderkey", "key_code", strata=["split"])
    coded = E.ordinal_encode(coded, "o_orderdate", "date_code")
    return coded.select("o_orderkey", "split", "key_code", "date_code")


#: these identify a line item
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def line_ids_all(spark: SparkSession, sf: str) -> DataFrame:
    """W4 on every line item."""
    li = table(spark, sf, "lineitem").select(*LINE_KEYS, "l_shipdate")
    return ordered_row_ids(li, LINE_KEYS, out="row_id")


# --- E3, E4, J4, U1: encode with an unknown class --------------------------------

def unknown_encode(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "event_type")
    split = SP.hash_split(ev, ["event_id"], 0.2, SEED)
    train = split.where((F.col("split") == "train") & (F.col("event_type") != "error"))
    test = split.where(F.col("split") == "test")
    d = E.fit_unknown_dictionary(train, "event_type")
    return E.encode(test, "event_type", d, "code", unseen="unknown").select("event_id", "event_type", "code")


# --- E5: one-hot ----------------------------------------------------------------

def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    flags = E.fit_dictionary(li, "l_returnflag").label_list()
    status = E.fit_dictionary(li, "l_linestatus").label_list()
    out = E.one_hot_columns(li, "l_returnflag", flags, prefix="rf")
    out = E.one_hot_columns(out, "l_linestatus", status, prefix="ls")
    return out.drop("l_returnflag", "l_linestatus")


# --- E6, E7: L2 normalisation ----------------------------------------------------

def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols)
    n = E.l2_normalize(li, cols, prefix="n_")
    return n.select("l_orderkey", "l_linenumber", *[_r(F.col(f"n_{c}")).alias(f"n_{c}") for c in cols],
                    S.sign01(F.col("l_linenumber") - 4).alias("sign"))


# --- E8: population standardisation ----------------------------------------------

def standardize(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["l_quantity", "l_extendedprice"]
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols)
    split = SP.hash_split(li, ["l_orderkey", "l_linenumber"], 0.2, SEED)
    scaler = E.PopulationScaler.fit(split.where(F.col("split") == "train"), cols)
    z = scaler.transform(split)
    return z.select("l_orderkey", "l_linenumber", "split", *[_r(F.col(f"z_{c}")).alias(f"z_{c}") for c in cols])


# --- A10, A11: class weights -----------------------------------------------------

def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_mktsegment")
    w = M.class_weights(c, "c_mktsegment", SEGMENT_OVERRIDES, SEGMENT_MULTIPLIERS)
    return w.select("label", "n", _r(F.col("weight")).alias("weight"), _r(F.col("adjusted")).alias("adjusted"))


# --- A12: cross-entropy ----------------------------------------------------------

def log_loss(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_discount", "l_tax", "l_quantity", "l_returnflag")
    y = (F.col("l_returnflag") == "R").cast("int")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("l_discount") * 40 - 2)))
    probs = F.array(F.col("l_discount") + 0.01, F.col("l_tax") + 0.01, F.col("l_quantity") / F.lit(500.0))
    code = F.array_position(F.array(*[F.lit(x) for x in FLAG_LABELS]), F.col("l_returnflag")) - 1
    scored = li.select(y.alias("y"), p.alias("p"), probs.alias("probs"), code.alias("code"))
    return scored.agg(
        _r(M.binary_log_loss("y", "p")).alias("binary_loss"),
        _r(F.avg((L.threshold("p", 0.5) == F.col("y")).cast("double"))).alias("binary_accuracy"),
        _r(M.sparse_log_loss("code", "probs")).alias("categorical_loss"))


# --- A13, W1-W3: training-history analytics ---------------------------------------

def epoch_history(spark: SparkSession, sf: str) -> DataFrame:
    hist = H.events_history(table(spark, sf, "events"))
    summary = H.history_summary(hist, patience=3)
    return summary.select("run_id", "n_epochs", _r(F.col("mean_accuracy")).alias("mean_accuracy"),
                          "epochs_to_learn", "overfit_epoch", "stop_epoch", "best_epoch")


# --- W6-W8: best-candidate selectors ---------------------------------------------

def selectors(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_brand", "p_retailprice")
    return SEL.part_selectors(part, seed=SEED).select("selector", "candidate", _r(F.col("score")).alias("score"))


# --- W4, R2-R8, P8, P9: ids, splits, folds, flips ----------------------------------

def row_ids(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id")
    return ordered_row_ids(ev, "event_id", out="row_id")


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id")
    a = SP.hash_split(ev, ["event_id"], 0.2, SEED, exact=False, out="split_expected")
    return SP.hash_split(a, ["event_id"], 0.2, SEED, exact=True, out="split_exact")


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return SP.stratified_split(ev, ["event_id"], "event_type", 0.2, SEED)


def kfold(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    a = SP.kfold(o, ["o_orderkey"], 5, SEED, out="fold")
    b = SP.stratified_kfold(a, ["o_orderkey"], "o_orderpriority", 5, SEED, out="strat_fold", keys_from=o)
    return b.select("o_orderkey", "fold", "strat_fold")


def tail_holdout(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey")
    return SP.tail_holdout(o, "o_orderkey", 0.2)


def label_flip(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "event_type")
    ev = ev.withColumn("is_view", L.indicator("event_type", "view"))
    flipped = SP.flip_labels(ev, "is_view", ["event_id"], 0.25, seed=7, out="flipped")
    ided = ordered_row_ids(flipped, "event_id", out="row_id")
    staged = ided.withColumn("staged", SP.by_row_range("row_id", 1000, F.col("flipped"),
                                                       S.complement("is_view")))
    return staged.select("event_id", "is_view", "flipped", "staged")


def label_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Labels by position (the last and last but one; the third from the end after
    a column is appended) of an inclusive slice of rows and of an open one."""
    o = table(spark, sf, "orders")
    labels = o.select("o_orderkey", F.col(o.columns[-1]).alias("last"), F.col(o.columns[-2]).alias("last_but_one"))
    more = o.withColumn("is_open", F.col("o_orderstatus") == "O")
    third = more.select(F.col("o_orderkey").alias("key"), F.col(more.columns[-3]).alias("third"))
    ided = ordered_row_ids(labels.join(third, F.col("o_orderkey") == F.col("key")).drop("key"),
                           "o_orderkey", out="row_id")
    a = SP.row_range(ided, "row_id", 1000, 1999).withColumn("part", F.lit("closed"))
    return a.unionByName(SP.row_range(ided, "row_id", 5000).withColumn("part", F.lit("open")))


# --- F2-F5: scalar formatting ----------------------------------------------------

def scalar_formats(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    return o.select("o_orderkey", S.fixed4("o_totalprice").alias("price_text"),
                    S.stamp("o_orderdate").alias("date_text"),
                    _r(S.safe_div(F.col("o_totalprice"), F.length("o_orderpriority") - 8)).alias("ratio"),
                    F.floor(F.col("o_totalprice") * 0.25).cast("bigint").alias("quarter_floor"))


# --- J5, W9: nearest neighbours inside a class -----------------------------------

def knn(spark: SparkSession, sf: str) -> DataFrame:
    emb = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    nn = NB.knn_within_class(emb, "vec_id", "label", "embedding", k=5)
    return nn.select("vec_id", "label", "rank", "nbr_id", _r(F.col("d2")).alias("d2"))


def knn_close_all(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours of L2-normalised line items within a supplier, by row id in key order:
    distances far below 1e-9."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = ordered_row_ids(table(spark, sf, "lineitem").select(*LINE_KEYS, *cols), LINE_KEYS, out="row_key")
    n = E.l2_normalize(li, cols, prefix="n_").select(
        "row_key", "l_suppkey", F.array(*[F.col(f"n_{c}") for c in cols]).alias("v"))
    return NB.knn_within_class(n, "row_key", "l_suppkey", "v", k=5)


# --- R1, U3: SMOTE ----------------------------------------------------------------

def smote(spark: SparkSession, sf: str) -> DataFrame:
    emb = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    out = RS.smote(emb, "vec_id", "label", "embedding", k=5, seed=SEED)
    s = RS.smote_summary(out, "label", "embedding")
    return s.select("label", "n_original", "n_synthetic", "n_total",
                    S.round_half_away("synthetic_sum", 4).alias("synthetic_sum"))


# --- S1/S4, S5/S8: sinks read back ------------------------------------------------

#: files that are read back at once: compressed, each of as many rows as a task may read
SCRATCH_CSV = {"compression": "lz4", "rows_per_file": 250_000}


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    path = SK.scratch_path(spark, "orders-csv")
    SK.write_csv(orders, path, **SCRATCH_CSV)
    return CSV.read_csv_typed(spark, path, orders.schema)


def csv_headerless(spark: SparkSession, sf: str) -> DataFrame:
    """S1/S2 read path: a headerless CSV read back with declared names and types
    (FAILFAST), as the connection records are read."""
    li = table(spark, sf, "lineitem")
    path = SK.scratch_path(spark, "lineitem-csv")
    SK.write_csv(li, path, header=False, **SCRATCH_CSV)
    return CSV.read_csv_typed(spark, path, li.schema, header=False)


RUN_ID = SK.run_id(0.25, (0.001, 0.001), 100)


def metrics_sink(spark: SparkSession, sf: str) -> DataFrame:
    rates = confusion_rates(spark, sf)
    long = SK.metrics_long(rates, "class", ["tp", "fp", "fn", "tn", "fpr", "fnr"], RUN_ID, "binary")
    path = SK.scratch_path(spark, "metrics")
    SK.append_metrics(long, path)
    schema = "stage string, class string, metric string, value double, run_id string"
    return spark.read.schema(schema).parquet(path).select("run_id", "stage", "class", "metric", "value")


# --- R (commented-out variant): resampling to target counts --------------------------

EVENT_TARGETS = {"click": 1500, "view": 2500}


def resample_counts(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "event_type")
    out = RS.resample_to_counts(ev, ["event_id"], "event_type", EVENT_TARGETS, seed=SEED)
    return out.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_events"),
        F.max("copy").alias("max_copy"), F.sum("event_id").alias("id_sum"))


# --- A6 variant, J6, U2, E9, A14 --------------------------------------------------------

EVENT_LISTS = {"engagement": ["click", "view"], "conversion": ["purchase", "signup"]}


def _event_rule(ev: DataFrame) -> DataFrame:
    pred = (F.when(F.col("value") < 10, "view").when(F.col("value") < 50, "click")
             .when(F.col("value") < 200, "purchase").otherwise("error"))
    return ev.select(F.col("event_type").alias("actual"), pred.alias("predicted"))


def grouped_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_type", "value")
    acc = M.grouped_accuracy(_event_rule(ev), "actual", "predicted", EVENT_LISTS)
    return acc.select("class", "total", "correct", _r(F.col("accuracy")).alias("accuracy"))


def label_sets(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_discount")
    union = E.label_union(_flag_rule(li), "actual", "predicted", out="label")              # U2
    cust = table(spark, sf, "customer").select("c_mktsegment")
    d = E.fit_dictionary(cust, "c_mktsegment")
    present = E.present_classes(d, E.encode(cust, "c_mktsegment", d, "code"), "code")                                           # J6
    n_classes = li.agg(E.class_count(li, "l_returnflag").cast("bigint").alias("value"))   # E9
    counts = M.count_fraction(li, 0.25)                                                   # A14
    none = F.lit(None).cast("string")
    return (union.select(F.lit("union").alias("kind"), "label", F.lit(None).cast("bigint").alias("value"))
            .unionByName(present.select(F.lit("present").alias("kind"), F.col("value").alias("label"),
                                        F.col("code").cast("bigint").alias("value")))
            .unionByName(n_classes.select(F.lit("n_classes").alias("kind"), none.alias("label"), "value"))
            .unionByName(counts.select(F.lit("count").alias("kind"), none.alias("label"),
                                       F.col("n").cast("bigint").alias("value")))
            .unionByName(counts.select(F.lit("fraction").alias("kind"), none.alias("label"),
                                       F.col("n_fraction").alias("value"))))


def label_sets_test(spark: SparkSession, sf: str) -> DataFrame:
    """J6 on a keyed split: the segments of all customers and those present in the test part."""
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    d = E.fit_dictionary(cust, "c_mktsegment")
    test = SP.hash_split(cust, ["c_custkey"], 0.2, SEED).where(F.col("split") == "test")
    present = E.present_classes(d, E.encode(test, "c_mktsegment", d, "code"), "code")
    row = lambda kind: (F.lit(kind).alias("kind"), F.col("value").alias("label"),
                        F.col("code").cast("bigint").alias("value"))
    return d.table.select(*row("all")).unionByName(present.select(*row("present")))


# --- streaming: running confusion counts over the events file ---------------------------

def stream_confusion(spark: SparkSession, sf: str) -> DataFrame:
    from vigil.streaming import running_confusion, start_to_path
    schema = table(spark, sf, "events").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
                   .parquet(sf.rstrip("/")))
    out = SK.scratch_path(spark, "stream-result")
    q = start_to_path(running_confusion(_event_rule(stream), "actual", "predicted"),
                      SK.scratch_path(spark, "stream-checkpoint"), out)
    q.awaitTermination()   # ends when all available input is read; raises if the stream fails
    return spark.read.schema("actual string, predicted string, n bigint").parquet(out)


# --- J1: attach separately computed predictions by key ----------------------------------

PRICE_CUTS = (50000.0, 150000.0, 300000.0)


def attach_order_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Per-order rule predictions (a separate table keyed by order) attached to every
    line item of the order."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    lo, mid, hi = PRICE_CUTS
    pred = (F.when(F.col("o_totalprice") < lo, "small").when(F.col("o_totalprice") < mid, "medium")
             .when(F.col("o_totalprice") < hi, "large").otherwise("huge"))
    preds = o.select("o_orderkey", pred.alias("predicted"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    out = AT.attach_predictions(li, preds, ["l_orderkey"], ["o_orderkey"])
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "predicted")


def positional_attach(spark: SparkSession, sf: str) -> DataFrame:
    """J1 + P8 + R7 by position: every order with the line item at the same place of its file, a
    column that is the line's parity for the first 1,000 rows and the order's flag after them, and
    the last fifth of the rows held out."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    held = AT.tail_by_position(orders, 0.2).select("o_orderkey", "split")
    zipped = AT.attach_by_position(orders, lines)
    value = SP.by_row_range("position", 1000, F.col("l_linenumber") % 2, L.indicator("o_orderstatus", "F"))
    return (zipped.withColumn("value", value.cast("int")).join(held, "o_orderkey")
            .select("position", "o_orderkey", "l_orderkey", "l_linenumber", "value", "split"))


def stratified_split_total(spark: SparkSession, sf: str) -> DataFrame:
    """R3 as the library does it: the test total is fixed first, then apportioned by largest
    remainder."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return SP.stratified_split(orders, ["o_orderkey"], "o_orderpriority", 0.2, SEED, apportion="total")


def connections_42(spark: SparkSession, sf: str) -> DataFrame:
    """Line items written as headerless records of 42 fields and read with their declared names
    and types."""
    li = table(spark, sf, "lineitem")
    path = SK.scratch_path(spark, "connections")
    SK.write_csv(li.select(*[F.expr(e).alias(c) for c, e in connection_fields().items()]), path, header=False,
                 **SCRATCH_CSV)
    return CSV.read_connections(spark, path, with_difficulty=False)


def connection_fields() -> dict[str, str]:
    """A line-item expression of the declared type for each of the 42 fields."""
    kinds = {"string": "l_returnflag || l_linestatus", "int": "l_linenumber % 2", "double": "l_discount",
             "bigint": "l_partkey + {i}"}
    fields = CSV.connection_schema(with_difficulty=False).fields
    return {f.name: kinds[f.dataType.simpleString()].format(i=i) for i, f in enumerate(fields)}


def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """S3: names from the first record of each file, types inferred."""
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = SK.scratch_path(spark, "customers")
    SK.write_csv(cust, path)
    return CSV.read_with_header(spark, path)


def run_clock(spark: SparkSession, sf: str) -> DataFrame:
    """F3 + S5: rows and a day-time interval of three stages of a run, from observed actions; seconds
    go to the metrics sink."""
    clock = RunClock(spark, RUN_ID)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    clock.stage("scan", orders, noop)
    split = clock.stage("split", SP.hash_split(orders, ["o_orderkey"], 0.2, SEED), lambda df: SK.kept(df, "split"))
    clock.stage("priorities", split.where("split = 'test'").groupBy("o_orderpriority").count(), noop)
    path = SK.scratch_path(spark, "clock")
    SK.append_metrics(clock.metrics(), path)
    seconds = (spark.read.parquet(path).where("metric = 'seconds'")
               .select("stage", (F.col("value") >= 0).alias("in_sink")))
    return (clock.table().join(seconds, "stage").select(
        F.col("run_id"), F.col("place"), "stage", F.col("rows").alias("n_rows"), "in_sink",
        (F.col("elapsed") >= F.expr("INTERVAL '0' SECOND")).alias("elapsed_ok")))
