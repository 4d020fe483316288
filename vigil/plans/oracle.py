"""DuckDB SQL oracles for the registered queries (same names, same output columns).

Written independently of the Spark code: plain SQL over the pre-registered driver
views, global windows included (the oracle only runs at small scale).
"""

from __future__ import annotations


def H(seed, *keys: str) -> str:
    """Keyed u32 hash, the SQL twin of ``vigil.functions.scalar.keyed_u32``."""
    parts = ", ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"CAST(('0x' || substr(md5(concat_ws('|', {parts})), 1, 8)) AS BIGINT)"


T20 = 858993459  # floor(0.2 * 2^32)

FLAG_RULE = """
  SELECT l_returnflag AS actual,
         CASE WHEN l_discount < 0.03::DOUBLE THEN 'A' WHEN l_discount < 0.06::DOUBLE THEN 'N'
              WHEN l_discount < 0.09::DOUBLE THEN 'R' ELSE 'U' END AS predicted
  FROM lineitem"""


def _per_class(scored: str) -> str:
    """CTEs ``cells``, ``lbl``, ``cm``, ``per`` (class, tp, fp, fn, tn, support, predicted_n)."""
    return f"""
scored AS ({scored}),
cells AS (SELECT actual, predicted, count(*) AS n FROM scored GROUP BY actual, predicted),
lbl AS (SELECT actual AS label FROM cells UNION SELECT predicted FROM cells),
cm AS (SELECT a.label AS actual, p.label AS predicted, coalesce(c.n, 0) AS n
       FROM lbl a CROSS JOIN lbl p
       LEFT JOIN cells c ON c.actual IS NOT DISTINCT FROM a.label
                        AND c.predicted IS NOT DISTINCT FROM p.label),
per AS (SELECT l.label AS class,
          CAST(sum(CASE WHEN cm.actual IS NOT DISTINCT FROM l.label AND cm.predicted IS NOT DISTINCT FROM l.label THEN n ELSE 0 END) AS BIGINT) AS tp,
          CAST(sum(CASE WHEN cm.actual IS DISTINCT FROM l.label AND cm.predicted IS NOT DISTINCT FROM l.label THEN n ELSE 0 END) AS BIGINT) AS fp,
          CAST(sum(CASE WHEN cm.actual IS NOT DISTINCT FROM l.label AND cm.predicted IS DISTINCT FROM l.label THEN n ELSE 0 END) AS BIGINT) AS fn,
          CAST(sum(CASE WHEN cm.actual IS DISTINCT FROM l.label AND cm.predicted IS DISTINCT FROM l.label THEN n ELSE 0 END) AS BIGINT) AS tn,
          CAST(sum(CASE WHEN cm.actual IS NOT DISTINCT FROM l.label THEN n ELSE 0 END) AS BIGINT) AS support,
          CAST(sum(CASE WHEN cm.predicted IS NOT DISTINCT FROM l.label THEN n ELSE 0 END) AS BIGINT) AS predicted_n
        FROM lbl l CROSS JOIN cm GROUP BY l.label)"""


def _div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0::DOUBLE END)"


CONFUSION_RATES = f"""
WITH {_per_class('''SELECT CAST(l.quality AS BIGINT) AS actual, CAST(d.n_chars > 500 AS BIGINT) AS predicted
                     FROM labels l JOIN documents d ON l.doc_id = d.doc_id''')}
SELECT class, tp, fp, fn, tn, round({_div('fp', 'fp + tn')}, 6) AS fpr, round({_div('fn', 'fn + tp')}, 6) AS fnr
FROM per"""

CONFUSION_MATRIX = f"""
WITH {_per_class(FLAG_RULE)}
SELECT actual, predicted, CAST(n AS BIGINT) AS n FROM cm"""

CLASS_REPORT = f"""
WITH {_per_class(FLAG_RULE)},
prf0 AS (SELECT CAST(class AS VARCHAR) AS class, tp, fp, fn, support, predicted_n, support > 0 AS in_l,
                {_div('tp', 'tp + fp')} AS precision, {_div('tp', 'tp + fn')} AS recall FROM per),
prf AS (SELECT *, {_div('2 * precision * recall', 'precision + recall')} AS f1 FROM prf0),
tot AS (SELECT sum(tp) FILTER (WHERE in_l) AS tp, sum(fp) FILTER (WHERE in_l) AS fp,
               sum(fn) FILTER (WHERE in_l) AS fn, sum(support) FILTER (WHERE in_l) AS support,
               avg(precision) FILTER (WHERE in_l) AS mp, avg(recall) FILTER (WHERE in_l) AS mr,
               avg(f1) FILTER (WHERE in_l) AS mf,
               {_div('sum(precision * support) FILTER (WHERE in_l)', 'sum(support) FILTER (WHERE in_l)')} AS wp,
               {_div('sum(recall * support) FILTER (WHERE in_l)', 'sum(support) FILTER (WHERE in_l)')} AS wr,
               {_div('sum(f1 * support) FILTER (WHERE in_l)', 'sum(support) FILTER (WHERE in_l)')} AS wf,
               coalesce(sum(predicted_n) FILTER (WHERE NOT in_l), 0) AS pred_outside
        FROM prf),
micro0 AS (SELECT *, {_div('tp', 'tp + fp')} AS p, {_div('tp', 'tp + fn')} AS r FROM tot),
micro AS (SELECT *, {_div('2 * p * r', 'p + r')} AS f FROM micro0)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM prf WHERE in_l
UNION ALL
SELECT CASE WHEN pred_outside = 0 THEN 'accuracy' ELSE 'micro avg' END,
       CASE WHEN pred_outside = 0 THEN NULL ELSE round(p, 6) END,
       CASE WHEN pred_outside = 0 THEN NULL ELSE round(r, 6) END, round(f, 6), CAST(support AS BIGINT) FROM micro
UNION ALL
SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(support AS BIGINT) FROM micro
UNION ALL
SELECT 'weighted avg', round(wp, 6), round(wr, 6), round(wf, 6), CAST(support AS BIGINT) FROM micro"""

REPORT_WITH_LABEL_LIST = CLASS_REPORT.replace("support > 0 AS in_l", "class IN ('A', 'N') AS in_l").replace(
    "sum(predicted_n) FILTER (WHERE NOT in_l)", "sum(predicted_n + support) FILTER (WHERE NOT in_l)")

_NULLS = """SELECT l.l_returnflag AS actual, p.predicted FROM lineitem l LEFT JOIN (
  SELECT o_orderkey, CASE WHEN o_totalprice < 100000.0::DOUBLE THEN 'A'
    WHEN o_totalprice < 200000.0::DOUBLE THEN 'N' ELSE 'R' END AS predicted
  FROM orders WHERE o_orderstatus <> 'F') p ON l.l_orderkey = p.o_orderkey"""

METRICS_WITH_NULLS = f"""
WITH {_per_class(_NULLS)}
SELECT class, tp, fp, fn, tn, support, predicted_n,
  round((SELECT sum(tp) / sum(support) FROM per), 6) AS accuracy FROM per"""

_BRANDS = """SELECT a.p_brand || '/' || a.p_type AS actual, b.p_brand || '/' || b.p_type AS predicted
  FROM part a JOIN part b ON b.p_partkey - 7 = a.p_partkey"""

BRAND_CONFUSION = f"""
WITH scored AS ({_BRANDS}),
cells AS (SELECT actual, predicted, count(*) AS n FROM scored GROUP BY actual, predicted),
lbl AS (SELECT actual AS label FROM cells UNION SELECT predicted FROM cells)
SELECT a.label AS actual, p.label AS predicted, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM lbl a CROSS JOIN lbl p LEFT JOIN cells c ON c.actual = a.label AND c.predicted = p.label"""

F1_SUMMARY = f"""
WITH {_per_class(FLAG_RULE)},
prf0 AS (SELECT *, {_div('tp', 'tp + fp')} AS p, {_div('tp', 'tp + fn')} AS r FROM per),
prf AS (SELECT *, {_div('2 * p * r', 'p + r')} AS f1 FROM prf0)
SELECT round({_div('sum(tp)', 'sum(support)')}, 6) AS accuracy,
       round({_div('2 * sum(tp)', '2 * sum(tp) + sum(fp) + sum(fn)')}, 6) AS f1_micro,
       round(avg(f1), 6) AS f1_macro,
       round({_div('sum(f1 * support)', 'sum(support)')}, 6) AS f1_weighted
FROM prf"""

CLASS_ACCURACY = f"""
WITH s AS ({FLAG_RULE}),
a AS (SELECT actual AS class, count(*) AS total, sum(CASE WHEN actual = predicted THEN 1 ELSE 0 END) AS correct
      FROM s GROUP BY actual),
fixed AS (SELECT * FROM (VALUES ('A'), ('N'), ('R'), ('Z')) t(class))
SELECT f.class, CAST(coalesce(a.total, 0) AS BIGINT) AS total, CAST(coalesce(a.correct, 0) AS BIGINT) AS correct,
       round({_div('coalesce(a.correct, 0)', 'coalesce(a.total, 0)')}, 6) AS accuracy
FROM fixed f LEFT JOIN a ON f.class = a.class"""

BINARY_RELABEL = """
SELECT event_id,
       CASE WHEN event_type IS NOT DISTINCT FROM 'view' THEN 'view' ELSE 'other' END AS binary_type,
       CAST(coalesce(CAST(event_type = 'view' AS INTEGER), 0) AS INTEGER) AS is_view,
       CAST(event_type IN ('click', 'purchase') AS INTEGER) AS in_list
FROM events"""

_EVENT_CASE = """CASE WHEN event_type IN ('click', 'view') THEN 'engagement'
            WHEN event_type IN ('purchase') THEN 'conversion'
            WHEN event_type = 'signup' THEN 'signup' ELSE 'unknown' END"""

TAXONOMY_RELABEL = f"""
SELECT event_id, {_EVENT_CASE} AS category, {_EVENT_CASE} AS category_join FROM events"""

FEATURE_PROJECTION = """
SELECT l_orderkey, l_linenumber, CAST(5 AS BIGINT) AS width,
       round(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE), 6) AS f0,
       round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE), 6) AS f1,
       round(CAST(CAST(l_discount AS FLOAT) AS DOUBLE), 6) AS f2,
       round(CAST(CAST(l_tax AS FLOAT) AS DOUBLE), 6) AS f3,
       CASE WHEN l_linenumber > 3 THEN 1.0 ELSE 0.0 END::DOUBLE AS last
FROM lineitem WHERE l_returnflag = 'R'"""

ARGMAX_DECODE = """
WITH s AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_discount,
                  [l_discount, l_tax, l_quantity / 500.0::DOUBLE] AS sc FROM lineitem),
c AS (SELECT *, CAST(list_position(sc, list_max(sc)) - 1 AS INTEGER) AS code FROM s)
SELECT l_orderkey, l_linenumber, code, ['A', 'N', 'R'][code + 1] AS predicted,
       CAST(l_returnflag = ['A', 'N', 'R'][code + 1] AS INTEGER) AS hit,
       CAST(l_discount * 10 > 0.5::DOUBLE AS INTEGER) AS above,
       CAST(coalesce(list_position(['A', 'N', 'R'], l_returnflag), 0) - 1 AS INTEGER) AS flag_pos
FROM c"""

ORDINAL_ENCODE = f"""
WITH o AS (SELECT o_orderkey, o_orderpriority, o_orderstatus,
                  CASE WHEN {H(42, 'o_orderkey')} < {T20} THEN 'test' ELSE 'train' END AS split FROM orders),
pd AS (SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS code
       FROM (SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderpriority IS NOT NULL)),
sd AS (SELECT split, value, CAST(dense_rank() OVER (PARTITION BY split ORDER BY value) - 1 AS INTEGER) AS code
       FROM (SELECT DISTINCT split, o_orderstatus AS value FROM o WHERE o_orderstatus IS NOT NULL))
SELECT o.o_orderkey, pd.code AS priority_code, o.split, sd.code AS status_code,
       CAST((SELECT count(*) FROM pd) AS BIGINT) AS n_classes
FROM o LEFT JOIN pd ON o.o_orderpriority = pd.value
       LEFT JOIN sd ON o.split = sd.split AND o.o_orderstatus = sd.value"""

ENCODE_CUSTOMER_NAMES = """
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS name_code FROM customer"""

ENCODE_SPLIT_ORDERS = f"""
WITH o AS (SELECT o_orderkey, o_orderdate,
             CASE WHEN {H(42, 'o_orderkey')} < {T20} THEN 'test' ELSE 'train' END AS split FROM orders)
SELECT o_orderkey, split,
  CAST(dense_rank() OVER (PARTITION BY split ORDER BY o_orderkey) - 1 AS INTEGER) AS key_code,
  CAST(dense_rank() OVER (ORDER BY o_orderdate) - 1 AS INTEGER) AS date_code FROM o"""

LINE_IDS_ALL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS BIGINT) AS row_id
FROM lineitem"""

UNKNOWN_ENCODE = f"""
WITH s AS (SELECT event_id, event_type,
                  CASE WHEN {H(42, 'event_id')} < {T20} THEN 'test' ELSE 'train' END AS split FROM events),
d0 AS (SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS code
       FROM (SELECT DISTINCT event_type AS value FROM s
             WHERE split = 'train' AND event_type <> 'error' AND event_type IS NOT NULL)),
d AS (SELECT value, code FROM d0
      UNION ALL
      SELECT 'unknown', CAST((SELECT count(*) FROM d0) AS INTEGER)
      WHERE NOT EXISTS (SELECT 1 FROM d0 WHERE value = 'unknown'))
SELECT s.event_id, s.event_type,
       CAST(CASE WHEN s.event_type IS NULL THEN NULL
                 ELSE coalesce(d.code, (SELECT code FROM d WHERE value = 'unknown')) END AS INTEGER) AS code
FROM s LEFT JOIN d ON s.event_type = d.value WHERE s.split = 'test'"""

ONE_HOT = """
SELECT l_orderkey, l_linenumber,
       coalesce(CAST(l_returnflag = 'A' AS INTEGER), 0) AS rf_0,
       coalesce(CAST(l_returnflag = 'N' AS INTEGER), 0) AS rf_1,
       coalesce(CAST(l_returnflag = 'R' AS INTEGER), 0) AS rf_2,
       CAST(l_linestatus = 'O' AS INTEGER) AS ls
FROM lineitem"""

L2_NORMALIZE = """
WITH q AS (SELECT *, sqrt(l_quantity * l_quantity + l_extendedprice * l_extendedprice
                          + l_discount * l_discount + l_tax * l_tax) AS nrm FROM lineitem),
z AS (SELECT *, CASE WHEN nrm = 0 THEN 1.0::DOUBLE ELSE nrm END AS nz FROM q)
SELECT l_orderkey, l_linenumber,
       round(l_quantity / nz, 6) AS n_l_quantity, round(l_extendedprice / nz, 6) AS n_l_extendedprice,
       round(l_discount / nz, 6) AS n_l_discount, round(l_tax / nz, 6) AS n_l_tax,
       CAST(sign(l_linenumber - 4) AS DOUBLE) AS sign
FROM z"""

STANDARDIZE = f"""
WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
                  CASE WHEN {H(42, 'l_orderkey', 'l_linenumber')} < {T20} THEN 'test' ELSE 'train' END AS split
           FROM lineitem),
st AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
              avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM s WHERE split = 'train')
SELECT l_orderkey, l_linenumber, split,
       round((l_quantity - mq) / CASE WHEN sq IS NULL OR sq = 0 THEN 1.0::DOUBLE ELSE sq END, 6) AS z_l_quantity,
       round((l_extendedprice - mp) / CASE WHEN sp IS NULL OR sp = 0 THEN 1.0::DOUBLE ELSE sp END, 6) AS z_l_extendedprice
FROM s, st"""

CLASS_WEIGHTS = """
WITH c AS (SELECT c_mktsegment AS label, count(*) AS n FROM customer GROUP BY c_mktsegment),
w AS (SELECT label, n, CAST(sum(n) OVER () AS DOUBLE) / CAST(count(*) OVER () * n AS DOUBLE) AS weight FROM c)
SELECT label, CAST(n AS BIGINT) AS n, round(weight, 6) AS weight,
       round(CASE WHEN label = 'BUILDING' THEN 1.5::DOUBLE ELSE weight END
             * CASE WHEN label = 'MACHINERY' THEN 2.5::DOUBLE WHEN label = 'HOUSEHOLD' THEN 1.4::DOUBLE
                    ELSE 1.0::DOUBLE END, 6) AS adjusted
FROM w"""

LOG_LOSS = """
WITH s AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y,
                  1.0::DOUBLE / (1.0::DOUBLE + exp(-(l_discount * 40 - 2))) AS p,
                  [l_discount + 0.01::DOUBLE, l_tax + 0.01::DOUBLE, l_quantity / 500.0::DOUBLE] AS probs,
                  list_position(['A', 'N', 'R'], l_returnflag) - 1 AS code FROM lineitem),
c AS (SELECT *, least(greatest(p, 1e-7::DOUBLE), 1.0::DOUBLE - 1e-7::DOUBLE) AS pc,
             least(greatest(probs[code + 1] / (probs[1] + probs[2] + probs[3]), 1e-7::DOUBLE),
                   1.0::DOUBLE - 1e-7::DOUBLE) AS py FROM s)
SELECT round(-avg(y * ln(pc + 1e-7::DOUBLE) + (1 - y) * ln(1.0::DOUBLE - pc + 1e-7::DOUBLE)), 6) AS binary_loss,
       round(avg(CASE WHEN CAST(p > 0.5::DOUBLE AS INTEGER) = y THEN 1.0 ELSE 0.0 END::DOUBLE), 6) AS binary_accuracy,
       round(-avg(ln(py)), 6) AS categorical_loss
FROM c"""

EPOCH_HISTORY = """
WITH daily AS (SELECT event_type AS run_id, CAST(ts AS DATE) AS day,
                      sum(CAST(round(value * 100) AS BIGINT)) AS cents, count(*) AS n
               FROM events GROUP BY event_type, CAST(ts AS DATE)),
h AS (SELECT run_id, CAST(day - min(day) OVER (PARTITION BY run_id) AS INTEGER) AS epoch,
             CAST(cents AS DOUBLE) / n AS accuracy, CAST(n AS DOUBLE) AS val_accuracy,
             CAST(floor(CAST(cents AS DOUBLE) / n / 100) AS DOUBLE) AS val_loss FROM daily),
f AS (SELECT *, accuracy > lag(accuracy) OVER w AS learned,
             val_accuracy < lag(val_accuracy) OVER w AS overfit,
             min(val_loss) OVER (PARTITION BY run_id ORDER BY epoch
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before
      FROM h WINDOW w AS (PARTITION BY run_id ORDER BY epoch)),
f2 AS (SELECT *, best_before IS NULL OR val_loss < best_before AS improving FROM f),
f3 AS (SELECT *, max(CASE WHEN improving THEN epoch END) OVER (PARTITION BY run_id ORDER BY epoch
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_best FROM f2),
f4 AS (SELECT *, epoch - last_best >= 3 AS stop FROM f3)
SELECT run_id, CAST(count(*) AS BIGINT) AS n_epochs, round(avg(accuracy), 6) AS mean_accuracy,
       CAST(min(CASE WHEN learned THEN epoch + 1 END) AS BIGINT) AS epochs_to_learn,
       CAST(min(CASE WHEN overfit THEN epoch END) AS BIGINT) AS overfit_epoch,
       CAST(min(CASE WHEN stop THEN epoch END) AS BIGINT) AS stop_epoch,
       CAST(coalesce(arg_min(last_best, CASE WHEN stop THEN epoch END),
                     max(CASE WHEN improving THEN epoch END)) AS BIGINT) AS best_epoch
FROM f4 GROUP BY run_id"""

def _fold(r: str, n: str) -> str:
    return (f"CASE WHEN {r} < ({n} % 5) * ({n} // 5 + 1) THEN {r} // ({n} // 5 + 1) "
            f"ELSE ({n} % 5) + ({r} - ({n} % 5) * ({n} // 5 + 1)) // ({n} // 5) END")


SELECTORS = f"""
WITH p AS (SELECT p_partkey, p_size, p_brand, p_retailprice,
                  CASE WHEN p_retailprice > 1500.0::DOUBLE THEN 1.0 ELSE 0.0 END::DOUBLE AS hit,
                  row_number() OVER (ORDER BY {H(42, 'p_partkey')}, p_partkey) - 1 AS r,
                  count(*) OVER () AS n FROM part),
f AS (SELECT *, {_fold('r', 'n')} AS fold FROM p),
w6 AS (SELECT p_size AS grid_pos,
              list_reduce(list_sort(list(score)), lambda x, y: x + y) / count(score) AS score
       FROM (SELECT p_size, fold, avg(hit) AS score FROM f GROUP BY p_size, fold) GROUP BY p_size),
w7 AS (SELECT p_size AS n_features, round(avg(hit), 2) AS score FROM p GROUP BY p_size),
w8 AS (SELECT p_brand AS trial, avg(p_retailprice) AS score FROM p GROUP BY p_brand)
SELECT * FROM (SELECT 'best_candidate' AS selector, CAST(grid_pos AS VARCHAR) AS candidate, round(score, 6) AS score
               FROM w6 ORDER BY score DESC, grid_pos LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'best_prefix', CAST(n_features AS VARCHAR), round(score, 6)
               FROM w7 ORDER BY score DESC, n_features LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'best_trial', trial, round(score, 6) FROM w8 ORDER BY score DESC, trial LIMIT 1)"""

ROW_IDS = """
SELECT event_id, CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS row_id FROM events"""

HASH_SPLIT = f"""
SELECT event_id,
       CASE WHEN {H(42, 'event_id')} < {T20} THEN 'test' ELSE 'train' END AS split_expected,
       CASE WHEN row_number() OVER (ORDER BY {H(42, 'event_id')}, event_id) - 1
                 < ceil(0.2::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split_exact
FROM events"""

STRATIFIED_SPLIT = f"""
SELECT event_id, event_type,
       CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY {H(42, 'event_id')}, event_id) - 1
                 < ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY event_type)) THEN 'test' ELSE 'train' END AS split
FROM events"""

KFOLD = f"""
WITH p AS (SELECT o_orderkey, o_orderpriority,
                  row_number() OVER (ORDER BY {H(42, 'o_orderkey')}, o_orderkey) - 1 AS r,
                  count(*) OVER () AS n, count(*) OVER (PARTITION BY o_orderpriority) AS ns,
                  row_number() OVER (PARTITION BY o_orderpriority ORDER BY {H(42, 'o_orderkey')}, o_orderkey) - 1 AS rs
           FROM orders)
SELECT o_orderkey, CAST({_fold('r', 'n')} AS INTEGER) AS fold, CAST({_fold('rs', 'ns')} AS INTEGER) AS strat_fold FROM p"""

TAIL_HOLDOUT = """
SELECT o_orderkey,
       CASE WHEN row_number() OVER (ORDER BY o_orderkey) - 1 >= floor(count(*) OVER () * 0.8::DOUBLE)
            THEN 'val' ELSE 'train' END AS split
FROM orders"""

LABEL_FLIP = f"""
WITH e AS (SELECT event_id, CAST(coalesce(CAST(event_type = 'view' AS INTEGER), 0) AS INTEGER) AS is_view,
                  row_number() OVER (ORDER BY {H(7, 'event_id')}, event_id) - 1 AS r,
                  count(*) OVER () AS n,
                  row_number() OVER (ORDER BY event_id) - 1 AS row_id FROM events),
f AS (SELECT *, CAST(CASE WHEN r < floor(n * 0.25::DOUBLE) THEN 1 - is_view ELSE is_view END AS INTEGER) AS flipped
      FROM e)
SELECT event_id, is_view, flipped,
       CAST(CASE WHEN row_id < 1000 THEN flipped ELSE 1 - is_view END AS INTEGER) AS staged FROM f"""

SCALAR_FORMATS = """
SELECT o_orderkey, printf('%.4f', o_totalprice) AS price_text,
       strftime(o_orderdate, '%Y-%m-%d-%H-%M-%S') AS date_text,
       round(CASE WHEN length(o_orderpriority) - 8 <> 0
                  THEN o_totalprice / (length(o_orderpriority) - 8) ELSE 0.0::DOUBLE END, 6) AS ratio,
       CAST(floor(o_totalprice * 0.25::DOUBLE) AS BIGINT) AS quarter_floor
FROM orders"""

# folded from the left, so that the sum is the same to the last bit
_D2 = ("list_reduce(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])), "
       "lambda x, y: x + y)")

KNN = f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (SELECT a.vec_id, a.label, b.vec_id AS nbr_id, {_D2} AS d2
          FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, nbr_id) AS rank FROM pairs)
SELECT vec_id, label, CAST(rank AS INTEGER) AS rank, nbr_id, round(d2, 6) AS d2 FROM r WHERE rank <= 5"""

LABEL_SLICES = """
WITH o AS (SELECT o_orderkey, o_orderpriority AS last, o_orderdate AS last_but_one, o_orderdate AS third,
             CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_id FROM orders)
SELECT *, 'closed' AS part FROM o WHERE row_id BETWEEN 1000 AND 1999
UNION ALL
SELECT *, 'open' FROM o WHERE row_id >= 5000"""

KNN_CLOSE_ALL = f"""
WITH u AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_key,
             l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem),
q AS (SELECT *, sqrt(l_quantity * l_quantity + l_extendedprice * l_extendedprice
                  + l_discount * l_discount + l_tax * l_tax) AS nrm FROM u),
e AS (SELECT row_key, l_suppkey, [l_quantity / nz, l_extendedprice / nz, l_discount / nz, l_tax / nz] AS v
      FROM (SELECT *, CASE WHEN nrm = 0 THEN 1.0::DOUBLE ELSE nrm END AS nz FROM q)),
pairs AS (SELECT a.row_key, a.l_suppkey, b.row_key AS nbr_id, {_D2} AS d2
          FROM e a JOIN e b ON a.l_suppkey = b.l_suppkey AND a.row_key <> b.row_key),
r AS (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY d2, nbr_id) AS rank FROM pairs)
SELECT CAST(row_key AS BIGINT) AS row_key, l_suppkey, CAST(rank AS INTEGER) AS rank,
  CAST(nbr_id AS BIGINT) AS nbr_id, d2 FROM r WHERE rank <= 5"""

SMOTE = f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sz AS (SELECT label, count(*) AS n FROM e GROUP BY label),
tg AS (SELECT label, n, max(n) OVER () - n AS need FROM sz),
pairs AS (SELECT a.vec_id, b.vec_id AS nbr_id, {_D2} AS d2
          FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
          JOIN tg ON tg.label = a.label WHERE tg.need > 0),
nn0 AS (SELECT vec_id, nbr_id, row_number() OVER (PARTITION BY vec_id ORDER BY d2, nbr_id) AS rank
        FROM pairs),
nn AS (SELECT * FROM nn0 WHERE rank <= 5),
kc AS (SELECT vec_id, count(*) AS kk FROM nn GROUP BY vec_id),
r AS (SELECT e.vec_id, e.label, e.v, tg.need, tg.n,
             row_number() OVER (PARTITION BY e.label ORDER BY {H(42, 'e.vec_id')}, e.vec_id) - 1 AS r
      FROM e JOIN tg ON e.label = tg.label WHERE tg.need > 0),
q AS (SELECT *, need // n + CASE WHEN r < need % n THEN 1 ELSE 0 END AS quota FROM r),
d AS (SELECT vec_id, label, v, unnest(range(1, quota + 1)) AS j FROM q WHERE quota > 0),
dd AS (SELECT d.*, {H(42, 'd.vec_id', 'j', "'n'")} % kc.kk + 1 AS pick,
              CAST({H(42, 'd.vec_id', 'j', "'u'")} AS DOUBLE) / 4294967296.0::DOUBLE AS u
       FROM d JOIN kc ON kc.vec_id = d.vec_id),
syn AS (SELECT dd.label,
               list_sum(list_transform(range(1, len(dd.v) + 1), lambda i: dd.v[i] + dd.u * (b.v[i] - dd.v[i]))) AS s
        FROM dd JOIN nn ON nn.vec_id = dd.vec_id AND nn.rank = dd.pick JOIN e b ON b.vec_id = nn.nbr_id),
agg AS (SELECT label, count(*) AS cnt, sum(s) AS ssum FROM syn GROUP BY label)
SELECT sz.label, CAST(sz.n AS BIGINT) AS n_original, CAST(coalesce(agg.cnt, 0) AS BIGINT) AS n_synthetic,
       CAST(sz.n + coalesce(agg.cnt, 0) AS BIGINT) AS n_total,
       round(coalesce(agg.ssum, 0.0::DOUBLE), 4) AS synthetic_sum
FROM sz LEFT JOIN agg ON sz.label = agg.label"""


CSV_ROUNDTRIP = """SELECT * FROM orders"""

CSV_HEADERLESS = """SELECT * FROM lineitem"""

METRICS_SINK = f"""
WITH r AS ({CONFUSION_RATES}),
w AS (SELECT CAST(class AS VARCHAR) AS class, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp,
             CAST(fn AS DOUBLE) AS fn, CAST(tn AS DOUBLE) AS tn, fpr, fnr FROM r)
SELECT '0.25-0.001_0.001-100' AS run_id, 'binary' AS stage, class, metric, value
FROM (UNPIVOT w ON tp, fp, fn, tn, fpr, fnr INTO NAME metric VALUE value)"""


RESAMPLE_COUNTS = f"""
WITH r AS (SELECT event_id, event_type,
                  row_number() OVER (PARTITION BY event_type ORDER BY {H(42, 'event_id')}, event_id) - 1 AS r,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events),
t AS (SELECT *, CASE WHEN event_type = 'click' THEN 1500 WHEN event_type = 'view' THEN 2500 ELSE n END AS t FROM r),
c AS (SELECT *, CASE WHEN t <= n THEN CASE WHEN r < t THEN 1 ELSE 0 END
                     ELSE t // n + CASE WHEN r < t % n THEN 1 ELSE 0 END END AS copies FROM t),
e AS (SELECT event_id, event_type, unnest(range(1, copies + 1)) AS copy FROM c WHERE copies > 0)
SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT event_id) AS BIGINT) AS n_events,
       CAST(max(copy) AS BIGINT) AS max_copy, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM e GROUP BY event_type"""


_EVENT_RULE = """SELECT event_type AS actual,
       CASE WHEN value < 10.0::DOUBLE THEN 'view' WHEN value < 50.0::DOUBLE THEN 'click'
            WHEN value < 200.0::DOUBLE THEN 'purchase' ELSE 'error' END AS predicted FROM events"""

GROUPED_ACCURACY = f"""
WITH s AS ({_EVENT_RULE}),
g AS (SELECT * FROM (VALUES ('engagement', 'click'), ('engagement', 'view'),
                            ('conversion', 'purchase'), ('conversion', 'signup')) t(grp, name)),
a AS (SELECT g.grp, count(*) AS total, sum(CASE WHEN s.actual = s.predicted THEN 1 ELSE 0 END) AS correct
      FROM s JOIN g ON s.actual = g.name GROUP BY g.grp),
f AS (SELECT * FROM (VALUES ('engagement'), ('conversion')) t(grp))
SELECT f.grp AS class, CAST(coalesce(a.total, 0) AS BIGINT) AS total,
       CAST(coalesce(a.correct, 0) AS BIGINT) AS correct,
       round({_div('coalesce(a.correct, 0)', 'coalesce(a.total, 0)')}, 6) AS accuracy
FROM f LEFT JOIN a ON f.grp = a.grp"""

LABEL_SETS_TEST = f"""
WITH d AS (SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS BIGINT) AS code
           FROM (SELECT DISTINCT c_mktsegment AS value FROM customer WHERE c_mktsegment IS NOT NULL))
SELECT 'all' AS kind, value AS label, code AS value FROM d
UNION ALL
SELECT 'present', value, code FROM d
WHERE value IN (SELECT c_mktsegment FROM customer WHERE {H(42, 'c_custkey')} < {T20})"""

LABEL_SETS = f"""
WITH s AS ({FLAG_RULE}),
u AS (SELECT DISTINCT label FROM (SELECT actual AS label FROM s UNION ALL SELECT predicted FROM s)
      WHERE label IS NOT NULL),
d AS (SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS BIGINT) AS code
      FROM (SELECT DISTINCT c_mktsegment AS value FROM customer WHERE c_mktsegment IS NOT NULL))
SELECT 'union' AS kind, label, CAST(NULL AS BIGINT) AS value FROM u
UNION ALL
SELECT 'present', value, code FROM d
UNION ALL
SELECT 'n_classes', NULL, CAST(count(DISTINCT l_returnflag) AS BIGINT) FROM lineitem
UNION ALL
SELECT 'count', NULL, CAST(count(*) AS BIGINT) FROM lineitem
UNION ALL
SELECT 'fraction', NULL, CAST(floor(count(*) * 0.25::DOUBLE) AS BIGINT) FROM lineitem"""

STREAM_CONFUSION = f"""
SELECT actual, predicted, count(*) AS n FROM ({_EVENT_RULE})
GROUP BY actual, predicted"""


ATTACH_ORDER_PREDICTIONS = """
WITH p AS (SELECT o_orderkey,
                  CASE WHEN o_totalprice < 50000.0::DOUBLE THEN 'small'
                       WHEN o_totalprice < 150000.0::DOUBLE THEN 'medium'
                       WHEN o_totalprice < 300000.0::DOUBLE THEN 'large' ELSE 'huge' END AS predicted
           FROM orders)
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, p.predicted
FROM lineitem l LEFT JOIN p ON l.l_orderkey = p.o_orderkey"""


# --- models: what is exact around the fitted numbers --------------------------------------

_LINE_TEST = f"{H(42, 'l_orderkey', 'l_linenumber')} < {T20}"
_DOC_TEST = f"{H(42, 'doc_id')} < {T20}"

TREE_CASCADE = f"""
WITH t AS (SELECT l_returnflag AS class FROM lineitem WHERE {_LINE_TEST})
SELECT class, count(*) AS support, (SELECT count(*) FROM t) AS n_test, TRUE AS sums_ok FROM t GROUP BY class"""

WEIGHTED_LOGREG = f"""
WITH d AS (SELECT CAST(l.quality AS INTEGER) AS class, {_DOC_TEST.replace('doc_id', 'l.doc_id')} AS test
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
w AS (SELECT class, count(*) AS train_n, CAST(sum(count(*)) OVER () AS DOUBLE)
        / CAST(count(*) OVER () * count(*) AS DOUBLE) AS weight FROM d WHERE NOT test GROUP BY class),
t AS (SELECT class, count(*) AS support, CAST(sum(count(*)) OVER () AS BIGINT) AS n_test
      FROM d WHERE test GROUP BY class)
SELECT class, support, n_test, TRUE AS sums_ok, TRUE AS loss_ok, train_n,
  floor(weight * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE AS weight FROM t JOIN w USING (class)"""

_EMB = f"""e AS (SELECT vec_id, CAST(label AS INTEGER) AS class,
    row_number() OVER (PARTITION BY label ORDER BY {H(42, 'vec_id')}, vec_id) - 1
      < ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY label)) AS test FROM embeddings)"""

MLP_EMBEDDINGS = f"""
WITH {_EMB}
SELECT class, count(*) FILTER (test) AS support, CAST(sum(count(*) FILTER (test)) OVER () AS BIGINT) AS n_test,
  TRUE AS sums_ok, TRUE AS loss_ok, count(*) FILTER (NOT test) AS train_n, TRUE AS reload_same
FROM e GROUP BY class"""

TREE_GRID_SEARCH = """
WITH g AS (SELECT d.i AS di, d.depth, l.leaf
  FROM (VALUES (0, 30), (1, 10), (2, 20), (3, 25)) d(i, depth), (VALUES (1), (2), (3), (4), (5)) l(leaf))
SELECT CAST(di * 5 + leaf - 1 AS INTEGER) AS grid_pos, CAST(depth AS INTEGER) AS max_depth,
  CAST(leaf AS INTEGER) AS min_leaf, TRUE AS score_ok, TRUE AS best_ok FROM g"""

FOREST_ELIMINATION = """
WITH f AS (SELECT ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'l_linenumber', 'l_partkey',
                   'l_suppkey', 'ship_day'] AS names)
SELECT CAST(n AS INTEGER) AS n_features, array_to_string(names[:n], ',') AS features,
  TRUE AS score_ok, TRUE AS best_ok FROM f, range(1, 9) r(n)"""

MLP_SEARCH = """
WITH h AS (SELECT * FROM (VALUES (0, '32'), (1, '512'), (2, '32,32'), (3, '128,64'), (4, '64,64,64')) t(i, layers)),
r AS (SELECT * FROM (VALUES (0, 0.1::DOUBLE), (1, 0.01::DOUBLE), (2, 0.001::DOUBLE)) t(j, rate))
SELECT CAST(i * 3 + j AS INTEGER) AS trial, layers, rate, TRUE AS score_ok, TRUE AS best_ok FROM h, r"""

TWO_TARGETS = f"""
WITH d AS (SELECT l.quality, l.toxic FROM labels l JOIN documents d ON l.doc_id = d.doc_id
           WHERE {_DOC_TEST.replace('doc_id', 'l.doc_id')}),
u AS (SELECT 'quality' AS target, CAST(quality AS INTEGER) AS class FROM d
      UNION ALL SELECT 'toxic', CAST(toxic AS INTEGER) FROM d)
SELECT target, class, count(*) AS support, (SELECT count(*) FROM d) AS n_test, TRUE AS sums_ok, TRUE AS loss_ok
FROM u GROUP BY target, class"""

WARM_START = f"""
WITH {_EMB}
SELECT CASE WHEN test THEN 'test' ELSE 'train' END AS split, count(*) AS n, TRUE AS loss_falls
FROM e GROUP BY 1"""

CASCADE_FULL = f"""
WITH c AS (SELECT c_mktsegment AS class, {H(42, 'c_custkey')} < {T20} AS test,
             {H('42v', 'c_custkey')} < {T20} AS held FROM customer),
t AS (SELECT class, count(*) FILTER (test) AS support, count(*) FILTER (NOT test AND NOT held) AS n
      FROM c GROUP BY class)
SELECT class, support, CAST(sum(support) OVER () AS BIGINT) AS n_test, TRUE AS sums_ok,
  max(n) OVER () AS resampled_n, max(n) OVER () - n AS n_synthetic, TRUE AS losses_ok FROM t"""


_PARTS = f"""d AS (SELECT d.doc_id, lang, CASE WHEN {H(42, 'd.doc_id')} < {T20} THEN 'test'
    WHEN {H('42v', 'd.doc_id')} < 1073741824 THEN 'check' ELSE 'train' END AS part FROM documents d),
l AS (SELECT d.part, CAST(quality AS INTEGER) AS quality, CAST(toxic AS INTEGER) AS toxic
  FROM d JOIN labels USING (doc_id))"""
_LANGS = "lang IN ('de', 'en', 'es', 'fr')"
_MAJORITY = f"""m AS (SELECT CAST(sum(n) AS BIGINT) AS n_test, max(n) AS n_majority, TRUE AS above_majority
  FROM (SELECT lang, count(*) AS n FROM d WHERE part = 'test' AND {_LANGS} GROUP BY lang))"""

TREE_GRID_PRUNED = f"""
WITH {_PARTS}, {_MAJORITY},
g AS (SELECT a.i, depth, leaf, b.j, split
  FROM (VALUES (0, 30), (1, 10), (2, 20), (3, 25)) a(i, depth), (VALUES (1), (2), (3), (4), (5)) l(leaf),
       (VALUES (0, 2), (1, 3), (2, 4), (3, 5), (4, 10)) b(j, split)),
f AS (SELECT CAST(least(5, max(n)) AS INTEGER) AS folds FROM (SELECT count(*) AS n FROM d
      WHERE part != 'test' AND {_LANGS} GROUP BY lang))
SELECT CAST(i * 25 + (leaf - 1) * 5 + j AS INTEGER) AS grid_pos, CAST(depth AS INTEGER) AS max_depth,
  CAST(leaf AS INTEGER) AS min_leaf, CAST(split AS INTEGER) AS min_split, folds, n_test, n_majority, above_majority
FROM g, f, m"""

NETWORK_BINARY = f"""
WITH {_PARTS},
t AS (SELECT quality, count(*) AS n FROM l WHERE part = 'train' AND quality IS NOT NULL GROUP BY quality),
s AS (SELECT quality AS class, count(*) AS support FROM l WHERE part = 'test' AND quality IS NOT NULL GROUP BY quality)
SELECT class, support, n AS train_n, CASE class WHEN 0 THEN 1.5::DOUBLE ELSE 0.8::DOUBLE END AS weight,
  TRUE AS history_agrees, CAST(sum(support) OVER () AS BIGINT) AS n_test, max(support) OVER () AS n_majority,
  TRUE AS above_majority FROM s JOIN t ON t.quality = s.class"""

NETWORK_HEADS = f"""
WITH {_PARTS},
u AS (SELECT 'quality' AS target, quality AS class FROM l WHERE part = 'test'
      UNION ALL SELECT 'toxic', toxic FROM l WHERE part = 'test'),
c AS (SELECT target, class, count(*) AS n FROM u GROUP BY ALL)
SELECT target, CAST(sum(n) AS BIGINT) AS n_test, max(n) AS n_majority, TRUE AS above_majority, TRUE AS loss_falls
FROM c GROUP BY target"""

BANDIT_SEARCH = f"""
WITH {_PARTS}, {_MAJORITY},
r AS (SELECT * FROM (VALUES (0, 0, 2, 9, 3), (0, 1, 4, 3, 1), (0, 2, 10, 1, 0), (1, 0, 4, 5, 2), (1, 1, 10, 2, 0),
      (2, 0, 10, 3, 0)) t(bracket, rung, epochs, trials, survivors))
SELECT CAST(bracket AS INTEGER) AS bracket, CAST(rung AS INTEGER) AS rung, CAST(epochs AS INTEGER) AS epochs,
  CAST(trials AS BIGINT) AS trials, CAST(survivors AS BIGINT) AS survivors, TRUE AS best_survive, n_test, n_majority,
  above_majority FROM r, m"""

POSITIONAL_ATTACH = """
WITH o AS (SELECT row_number() OVER () - 1 AS position, count(*) OVER () AS n, o_orderkey, o_orderstatus FROM orders),
l AS (SELECT row_number() OVER () - 1 AS place, l_orderkey, l_linenumber FROM lineitem)
SELECT CAST(position AS BIGINT) AS position, o_orderkey, l_orderkey, l_linenumber,
  CAST(CASE WHEN position < 1000 THEN l_linenumber % 2 WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS value,
  CASE WHEN position >= floor(n * (1.0::DOUBLE - 0.2::DOUBLE)) THEN 'val' ELSE 'train' END AS split
FROM o LEFT JOIN l ON place = position"""

STRATIFIED_SPLIT_TOTAL = f"""
WITH s AS (SELECT o_orderpriority AS lab, count(*) AS c FROM orders GROUP BY 1),
t AS (SELECT sum(c) AS n, sum(c) - CAST(ceil(0.2::DOUBLE * sum(c)) AS BIGINT) AS n_train FROM s),
b AS (SELECT lab, c, n_train, (n_train * c) // n AS base, (n_train * c) % n AS rem FROM s, t),
r AS (SELECT *, row_number() OVER (ORDER BY rem DESC, lab NULLS FIRST) AS k, n_train - sum(base) OVER () AS rest FROM b),
x AS (SELECT lab, c - base - CASE WHEN k <= rest THEN 1 ELSE 0 END AS n_test FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {H(42, 'o_orderkey')}, o_orderkey) AS i FROM orders)
SELECT o_orderkey, o_orderpriority, CASE WHEN i <= n_test THEN 'test' ELSE 'train' END AS split
FROM o JOIN x ON lab IS NOT DISTINCT FROM o_orderpriority"""


def _connections_42() -> str:
    from vigil.plans.queries import connection_fields
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in connection_fields().items()) + " FROM lineitem"


CSV_INFERRED = """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer"""

RUN_CLOCK = f"""
WITH t AS (SELECT 0 AS place, 'scan' AS stage, count(*) AS n_rows FROM orders
  UNION ALL SELECT 1, 'split', count(*) FROM orders
  UNION ALL SELECT 2, 'priorities', count(DISTINCT o_orderpriority) FROM orders WHERE {H(42, 'o_orderkey')} < {T20})
SELECT '0.25-0.001_0.001-100' AS run_id, CAST(place AS INTEGER) AS place, stage, n_rows, TRUE AS in_sink,
  TRUE AS elapsed_ok FROM t"""

ORACLES = {
    "positional_attach": POSITIONAL_ATTACH,
    "stratified_split_total": STRATIFIED_SPLIT_TOTAL,
    "connections_42": _connections_42(),
    "csv_inferred": CSV_INFERRED,
    "run_clock": RUN_CLOCK,
    "tree_grid_pruned": TREE_GRID_PRUNED,
    "network_binary": NETWORK_BINARY,
    "network_heads": NETWORK_HEADS,
    "bandit_search": BANDIT_SEARCH,
    "cascade_full": CASCADE_FULL,
    "tree_cascade": TREE_CASCADE,
    "weighted_logreg": WEIGHTED_LOGREG,
    "mlp_embeddings": MLP_EMBEDDINGS,
    "tree_grid_search": TREE_GRID_SEARCH,
    "forest_elimination": FOREST_ELIMINATION,
    "mlp_search": MLP_SEARCH,
    "two_targets": TWO_TARGETS,
    "warm_start": WARM_START,
    "confusion_rates": CONFUSION_RATES,
    "confusion_matrix": CONFUSION_MATRIX,
    "class_report": CLASS_REPORT,
    "report_with_label_list": REPORT_WITH_LABEL_LIST,
    "metrics_with_nulls": METRICS_WITH_NULLS,
    "brand_confusion": BRAND_CONFUSION,
    "f1_summary": F1_SUMMARY,
    "class_accuracy": CLASS_ACCURACY,
    "binary_relabel": BINARY_RELABEL,
    "taxonomy_relabel": TAXONOMY_RELABEL,
    "feature_projection": FEATURE_PROJECTION,
    "argmax_decode": ARGMAX_DECODE,
    "ordinal_encode": ORDINAL_ENCODE,
    "encode_customer_names": ENCODE_CUSTOMER_NAMES,
    "encode_split_orders": ENCODE_SPLIT_ORDERS,
    "line_ids_all": LINE_IDS_ALL,
    "unknown_encode": UNKNOWN_ENCODE,
    "one_hot": ONE_HOT,
    "l2_normalize": L2_NORMALIZE,
    "standardize": STANDARDIZE,
    "class_weights": CLASS_WEIGHTS,
    "log_loss": LOG_LOSS,
    "epoch_history": EPOCH_HISTORY,
    "selectors": SELECTORS,
    "row_ids": ROW_IDS,
    "hash_split": HASH_SPLIT,
    "stratified_split": STRATIFIED_SPLIT,
    "kfold": KFOLD,
    "tail_holdout": TAIL_HOLDOUT,
    "label_flip": LABEL_FLIP,
    "label_slices": LABEL_SLICES,
    "scalar_formats": SCALAR_FORMATS,
    "knn": KNN,
    "knn_close_all": KNN_CLOSE_ALL,
    "smote": SMOTE,
    "csv_roundtrip": CSV_ROUNDTRIP,
    "csv_headerless": CSV_HEADERLESS,
    "metrics_sink": METRICS_SINK,
    "resample_counts": RESAMPLE_COUNTS,
    "grouped_accuracy": GROUPED_ACCURACY,
    "label_sets": LABEL_SETS,
    "label_sets_test": LABEL_SETS_TEST,
    "stream_confusion": STREAM_CONFUSION,
    "attach_order_predictions": ATTACH_ORDER_PREDICTIONS,
}
