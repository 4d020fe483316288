"""Run registered Spark queries and their DuckDB oracles side by side and compare
column names, types, row counts and values (order-insensitive).

    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import struct
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

SPARK_KIND = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int",
              "float": "float", "double": "float", "string": "str", "boolean": "bool",
              "date": "date", "timestamp": "ts", "timestamp_ntz": "ts"}
DUCK_KIND = {"TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int",
             "HUGEINT": "int", "FLOAT": "float", "DOUBLE": "float", "VARCHAR": "str",
             "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "ts"}
SPARK_TO_DUCK = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
                 "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _bits(x):
    return ("f", struct.pack("<d", x)) if isinstance(x, float) else x


def _key(row):
    return tuple((0, "") if x is None else (1, x if not isinstance(x, (int, float)) else float(x))
                 if not isinstance(x, str) else (2, x) for x in row)


def compare(spark_df, con, sql: str, tol: float = 1e-9) -> dict:
    t0 = time.time()
    s_types = dict(spark_df.dtypes)
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_types)) for r in spark_df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    order = sorted(d_cols)
    idx = [d_cols.index(c) for c in order]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    t2 = time.time()
    res = {"spark_sec": round(t1 - t0, 2), "duck_sec": round(t2 - t1, 2),
           "cols_match": sorted(s_types) == order, "rows": (len(s_rows), len(d_rows))}
    if not res["cols_match"]:
        res["cols"] = (sorted(s_types), order)
        return res
    res["type_mismatch"] = {c: (s_types[c], d_types[c]) for c in order
                            if SPARK_TO_DUCK.get(s_types[c]) != d_types[c]}
    s_sorted, d_sorted = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    # bit-level: -0.0 and 0.0 differ for a hash of the raw doubles
    res["exact"] = [tuple(_bits(x) for x in r) for r in s_sorted] == \
                   [tuple(_bits(x) for x in r) for r in d_sorted]
    if not res["exact"] and len(s_rows) == len(d_rows):
        bad = []
        for a, b in zip(s_sorted, d_sorted):
            for c, x, y in zip(order, a, b):
                if x != y and not (isinstance(x, float) and isinstance(y, (int, float))
                                   and abs(x - y) <= tol * max(1.0, abs(x), abs(y))):
                    bad.append((c, x, y))
        res["close"] = not bad
        res["first_bad"] = bad[:5]
    return res


def main(argv):
    from vigil.plans import QUERIES
    from vigil.plans.oracle import ORACLES
    from vigil.session import local_session
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")] or list(ORACLES)
    spark = local_session()
    con = duck_connection(sf_dir)
    ok = True
    for name in names:
        try:
            r = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
        except Exception as exc:  # noqa: BLE001
            r = {"error": repr(exc)[:600]}
        good = r.get("exact") and not r.get("type_mismatch")
        ok &= bool(good)
        print(("PASS " if good else "FAIL ") + name, r, flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
