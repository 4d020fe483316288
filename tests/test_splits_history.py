"""Ranks, splits, folds, flips (R2-R8, W4) and history / selector analytics."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.functions.scalar import keyed_u32
from vigil.operators import history as H
from vigil.operators import select as SEL
from vigil.operators import split as SP
from vigil.operators.ranking import hash_cuts, ordered_row_ids, value_at_rank


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(0, 5003).withColumnRenamed("id", "k") \
                .withColumn("lab", (F.col("k") % 7).cast("string"))


def test_hash_cuts_equal_single_window_for_any_bucket_count(spark, ids):
    naive = ids.withColumn("r", F.row_number().over(Window.orderBy(keyed_u32(42, "k"), "k")) - 1)
    marks = [0, 1, 700, 700, 5002, 5003, 9000]
    want = {r.k: sum(m <= r.r for m in marks) for r in naive.collect()}
    for bits in (1, 4, 12):
        got = hash_cuts(ids, ["k"], lambda n: [F.lit(m) for m in marks], 42, bucket_bits=bits)
        assert {r.k: r.passed for r in got.collect()} == want


def test_stratified_cuts_per_label(spark, ids):
    df = ids.withColumn("lab", F.when(F.col("k") % 7 > 0, F.col("lab")))  # a null stratum too
    r = hash_cuts(df, ["k"], lambda n: [F.floor(n / 3)], 42, partition_cols=["lab"], total_out="n",
                  bucket_bits=3)
    agg = r.groupBy("lab").agg(F.sum((F.col("passed") == 0).cast("int")).alias("below"),
                              F.count("*").alias("c"), F.first("n").alias("n")).collect()
    assert len(agg) == 7 and all(a.below == a.c // 3 and a.n == a.c for a in agg)


def test_cuts_shuffle_keys_only(spark):
    """No exchange carries a payload column."""
    from conftest import SF001
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").withColumn("y", F.lit(1))
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    for df in (SP.flip_labels(li, "y", keys, 0.25), SP.hash_split(li, keys, exact=True),
               SP.kfold(li, keys, 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        tree = plan.split("== Initial Plan ==")[-1]
        lines = tree.split("\n")
        for i, line in enumerate(lines):
            if " Exchange hashpartitioning" in line or " Exchange SinglePartition" in line:
                below = lines[i + 1]
                assert "l_comment" not in below and "l_extendedprice" not in below
        assert "Exchange hashpartitioning(l_" not in tree


def test_ordered_row_ids_dense_in_key_order(spark, ids):
    shuffled = ids.repartition(7)
    got = ordered_row_ids(shuffled, "k").collect()
    assert sorted((r.k, r.row_id) for r in got) == [(i, i) for i in range(5003)]
    two = ordered_row_ids(ids, ["lab", "k"], total_out="n").collect()
    assert [r.k for r in sorted(two, key=lambda r: r.row_id)] == [
        r.k for r in sorted(two, key=lambda r: (r.lab, r.k))]
    assert {r.n for r in two} == {5003} and ordered_row_ids(ids.limit(0), "k").count() == 0


def test_value_at_rank(spark, ids):
    for rank in (0, 17, 4000, 5002):
        assert value_at_rank(ids, "k", lambda n: rank, buckets=16, few=10) == (rank, 5003)
    assert value_at_rank(ids, "k", lambda n: n) == (None, 5003)
    skew = ids.select(F.exp(F.col("k") / 100).alias("x"))
    want = sorted(r.x for r in skew.collect())[1234]
    assert value_at_rank(skew, "x", lambda n: 1234, buckets=8, few=5)[0] == want


def test_exact_split_size_and_disjoint(spark, ids):
    out = SP.hash_split(ids, ["k"], 0.2, 42, exact=True)
    assert out.where("split = 'test'").count() == 1001              # ceil(0.2 * 5003)
    assert out.count() == 5003


def test_expected_split_is_partitioning_independent(spark, ids):
    a = {r.k for r in SP.hash_split(ids, ["k"]).where("split = 'test'").collect()}
    b = {r.k for r in SP.hash_split(ids.repartition(13), ["k"]).where("split = 'test'").collect()}
    assert a == b and 800 < len(a) < 1200


def test_stratified_split_counts(spark, ids):
    out = SP.stratified_split(ids, ["k"], "lab", 0.2)
    per = {r.lab: (r.t, r.n) for r in out.groupBy("lab").agg(
        F.sum((F.col("split") == "test").cast("int")).alias("t"), F.count("*").alias("n")).collect()}
    import math
    assert all(t == math.ceil(0.2 * n) for t, n in per.values())


def test_kfold_sizes_differ_by_at_most_one(spark, ids):
    sizes = sorted(r[1] for r in SP.kfold(ids, ["k"], 5).groupBy("fold").count().collect())
    assert sizes == [1000, 1000, 1001, 1001, 1001]
    strat = SP.stratified_kfold(ids, ["k"], "lab", 5)
    per = strat.groupBy("lab", "fold").count().groupBy("lab").agg((F.max("count") - F.min("count")).alias("d"))
    assert all(r.d <= 1 for r in per.collect())


def test_flip_exact_count(spark, ids):
    x = ids.withColumn("y", (F.col("k") % 2).cast("int"))
    out = SP.flip_labels(x, "y", ["k"], 0.25, seed=3, out="f")
    assert out.where("f != y").count() == int(5003 * 0.25)
    bal = SP.flip_labels(x, "y", ["k"], 0.2, seed=3, out="f", partition_cols=["y"])
    per = bal.where("f != y").groupBy("y").count().collect()
    assert sorted(r[1] for r in per) == [500, 500]


def test_tail_holdout(spark, ids):
    out = SP.tail_holdout(ids, "k", 0.2)
    val = sorted(r.k for r in out.where("split = 'val'").collect())
    assert val == list(range(int(5003 * 0.8), 5003))


def test_row_range_and_assignment(spark, ids):
    r = ordered_row_ids(ids, "k")
    assert SP.row_range(r, "row_id", 10, 19).count() == 10
    v = r.select(SP.by_row_range("row_id", 3, F.lit(1), F.lit(0)).alias("v")).groupBy("v").count()
    assert {x.v: x[1] for x in v.collect()} == {1: 3, 0: 5000}


# --- W1-W3 ----------------------------------------------------------------------------

def _hist(spark, run, acc, val_acc, val_loss):
    return spark.createDataFrame([(run, i, float(a), float(b), float(c))
                                  for i, (a, b, c) in enumerate(zip(acc, val_acc, val_loss))],
                                 "run_id string, epoch int, accuracy double, val_accuracy double, val_loss double")


def test_history_cases(spark):
    rise = _hist(spark, "rise", [1, 2, 3, 4, 5], [1, 2, 3, 4, 5], [5, 4, 3, 2, 1])
    fall = _hist(spark, "fall", [5, 4, 3, 2, 1], [5, 4, 3, 2, 1], [1, 2, 3, 4, 5])
    plateau = _hist(spark, "plateau", [1, 1, 1, 1, 1], [1, 1, 1, 1, 1], [2, 2, 2, 2, 2])
    one = _hist(spark, "one", [1], [1], [1])
    late = _hist(spark, "late", [3, 2, 2, 5], [1, 1, 0, 0], [4, 3, 3, 3])
    h = rise.unionByName(fall).unionByName(plateau).unionByName(one).unionByName(late)
    got = {r.run_id: r for r in H.history_summary(h, patience=3).collect()}
    assert (got["rise"].epochs_to_learn, got["rise"].overfit_epoch, got["rise"].stop_epoch,
            got["rise"].best_epoch) == (2, None, None, 4)
    assert (got["fall"].epochs_to_learn, got["fall"].overfit_epoch, got["fall"].stop_epoch,
            got["fall"].best_epoch) == (None, 1, 3, 0)
    # equal is not an improvement
    assert (got["plateau"].stop_epoch, got["plateau"].best_epoch) == (3, 0)
    assert (got["one"].n_epochs, got["one"].stop_epoch, got["one"].best_epoch) == (1, None, 0)
    assert (got["late"].epochs_to_learn, got["late"].overfit_epoch, got["late"].stop_epoch,
            got["late"].best_epoch) == (4, 2, None, 1)


# --- W6-W8 ------------------------------------------------------------------------------

def test_selectors_tie_rules(spark):
    res = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.7), (1, 0, 0.6), (1, 1, 0.6), (2, 0, 0.1), (2, 1, 0.2)],
                                "grid_pos int, fold int, score double")
    assert SEL.best_candidate(res, "grid_pos", "score", fold="fold").first().grid_pos == 0
    elim = spark.createDataFrame([(41, 0.9), (30, 0.95), (12, 0.95), (5, 0.8)], "n int, acc double")
    assert SEL.best_prefix(elim, "n", "acc").first().n == 12
    trials = spark.createDataFrame([("b", 0.3), ("a", 0.3), ("c", 0.1)], "t string, s double")
    assert SEL.best_trial(trials, "t", "s").first().t == "a"
    assert SEL.best_trial(trials, "t", "s", maximize=False).first().t == "c"


def test_ordered_row_ids_on_timestamps(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    got = ordered_row_ids(ev, "ts").select("event_id", "row_id")
    want = ev.withColumn("row_id", F.row_number().over(Window.orderBy("ts")) - 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("event_id", "row_id").collect()))


def test_xxhash_option_is_deterministic_and_exact(spark, ids):
    from vigil.functions.scalar import HASH_CONF
    spark.conf.set(HASH_CONF, "xxhash64")
    try:
        a = SP.hash_split(ids, ["k"], 0.2, 42, exact=True)
        assert a.where("split = 'test'").count() == 1001
        b = SP.hash_split(ids.repartition(9), ["k"], 0.2, 42, exact=True)
        assert {r.k for r in a.where("split = 'test'").collect()} == {r.k for r in b.where("split = 'test'").collect()}
        assert SP.kfold(ids, ["k"], 5).groupBy("fold").count().count() == 5
    finally:
        spark.conf.unset(HASH_CONF)


def test_ordered_row_ids_keep_null_keys(spark):
    df = spark.createDataFrame([(None,), (5,), (None,), (1,), (3,)], "k bigint")
    got = ordered_row_ids(df, "k", total_out="n").collect()
    assert len(got) == 5 and sorted(r.row_id for r in got) == [0, 1, 2, 3, 4]
    assert sorted(r.row_id for r in got if r.k is None) == [0, 1]
    assert [r.k for r in sorted(got, key=lambda r: r.row_id)][2:] == [1, 3, 5]


def test_stratified_split_total_first_apportioning(spark):
    # 3 labels of 7, 5 and 3 rows: n = 15, n_test = ceil(0.2 * 15) = 3, n_train = 12
    rows = [(i, "a") for i in range(7)] + [(10 + i, "b") for i in range(5)] + [(20 + i, "c") for i in range(3)]
    df = spark.createDataFrame(rows, "k bigint, lab string")
    out = SP.stratified_split(df, ["k"], "lab", 0.2, apportion="total")
    tests = {r.lab: r[1] for r in out.where("split = 'test'").groupBy("lab").count().collect()}
    # train: floor(12*7/15)=5 r9, floor(12*5/15)=4 r0, floor(12*3/15)=2 r6 -> one extra, to a -> 6, 4, 2
    assert tests == {"a": 1, "b": 1, "c": 1}
    # per label instead: ceil(1.4) + ceil(1.0) + ceil(0.6) = 4
    per_label = SP.stratified_split(df, ["k"], "lab", 0.2)
    assert per_label.where("split = 'test'").count() == 2 + 1 + 1


def test_positions_across_differently_parted_files(spark, scratch):
    from vigil.operators.attach import attach_by_position, tail_by_position
    (spark.range(1000).withColumn("a", F.col("id") * 3).repartition(5).write.parquet(f"{scratch}/a"))
    (spark.range(700).select((F.col("id") * 7).alias("b")).repartition(3).write.parquet(f"{scratch}/b"))
    a, b = spark.read.parquet(f"{scratch}/a"), spark.read.parquet(f"{scratch}/b")
    in_order = lambda path, c: [v for f in sorted(os.listdir(path)) if f.endswith(".parquet")
                                for v in pq.read_table(f"{path}/{f}").column(c).to_pylist()]
    left, right = in_order(f"{scratch}/a", "a"), in_order(f"{scratch}/b", "b")
    got = sorted((r.position, r.a, r.b) for r in attach_by_position(a, b).collect())
    assert got == [(i, x, right[i] if i < 700 else None) for i, x in enumerate(left)]
    held = {r.a for r in tail_by_position(a, 0.2).where("split = 'val'").collect()}
    assert held == set(left[800:])


def test_run_clock_counts_what_its_actions_read(spark):
    from vigil.operators.clock import RunClock
    clock = RunClock(spark, "run")
    assert clock.stage("count", spark.range(50), lambda df: df.count()) == 50
    clock.stage("none", spark.range(0), lambda df: df.collect())
    rows = clock.table().orderBy("place").collect()
    assert [(r.stage, r.rows) for r in rows] == [("count", 50), ("none", 0)]
    assert all(r.elapsed.total_seconds() >= 0 and r.ended >= r.began for r in rows)
    assert dict(clock.table().dtypes)["elapsed"] == "interval day to second"
    assert clock.metrics().where("metric = 'rows'").agg(F.sum("value")).first()[0] == 50


def test_positions_do_not_shuffle_rows_by_file(spark, scratch):
    from vigil.operators.attach import with_positions
    spark.range(1000).repartition(3).write.parquet(scratch + "/rows")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")     # as for a table of files whose size is not known to be small
    try:
        placed = with_positions(spark.read.parquet(scratch + "/rows"))
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert sorted(r.position for r in placed.collect()) == list(range(1000))
    finally:
        spark.conf.set(key, before)
