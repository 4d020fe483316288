"""Property tests: exact ranks and evaluation tables against brute force on random input."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.functions.scalar import keyed_u32
from vigil.operators import metrics as M
from vigil.operators.ranking import hash_cuts

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(keys=st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=300, unique=True),
       strata=st.integers(1, 4), bits=st.integers(1, 10), seed=st.integers(0, 99))
def test_hash_cuts_match_window(spark, keys, strata, bits, seed):
    df = spark.createDataFrame([(k, k % strata) for k in keys], "k bigint, s bigint")
    got = {r.k: (r.passed, r.n) for r in
           hash_cuts(df, ["k"], lambda n: [F.floor(n / 4), F.floor(n / 2), n], seed, partition_cols=["s"],
                     total_out="n", bucket_bits=bits).collect()}
    w = Window.partitionBy("s").orderBy(keyed_u32(seed, "k"), "k")
    rows = df.select("k", (F.row_number().over(w) - 1).alias("r"),
                     F.count("*").over(Window.partitionBy("s")).alias("n")).collect()
    assert got == {r.k: ((r.r >= r.n // 4) + (r.r >= r.n // 2), r.n) for r in rows}


@SETTINGS
@given(pairs=st.lists(st.tuples(st.sampled_from("abcde"), st.sampled_from("abcdef")), min_size=1, max_size=200))
def test_report_matches_brute_force(spark, pairs):
    df = spark.createDataFrame(pairs, "actual string, predicted string")
    rep = {r["class"]: r for r in M.classification_report(df, "actual", "predicted").collect()}
    present = sorted({a for a, _ in pairs})
    for c in present:
        tp = sum(1 for a, p in pairs if a == c and p == c)
        pred = sum(1 for _, p in pairs if p == c)
        sup = sum(1 for a, _ in pairs if a == c)
        prec = tp / pred if pred else 0.0
        rec = tp / sup if sup else 0.0
        assert math.isclose(rep[c].precision, prec) and math.isclose(rep[c].recall, rec)
        assert rep[c].support == sup
    micro = "accuracy" if {p for _, p in pairs} <= set(present) else "micro avg"
    assert micro in rep and rep[micro].support == len(pairs)
    rates = {r["class"]: r for r in M.class_rates(df, "actual", "predicted").collect()}
    for c, r in rates.items():
        assert r.tp + r.fp + r.fn + r.tn == len(pairs)
