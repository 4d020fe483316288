"""Every oracle-checked query equals its DuckDB SQL at sf0.01: same column names and
types, same row count, same values (order-insensitive, exact)."""

import pytest

from conftest import SF01
from oracle_harness import compare, duck_connection
from vigil.plans import all_queries
from vigil.plans.oracle import ORACLES


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF01)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(all_queries()[name](spark, SF01), con, ORACLES[name])
    assert res["cols_match"], res
    assert res["rows"][0] == res["rows"][1], res
    assert not res["type_mismatch"], res
    assert res["exact"], res


def test_line_queries_keep_every_row(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    n = li.count()
    ids = all_queries()["line_ids_all"](spark, SF01)
    assert n == ids.count() == ids.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct().count()
    assert all_queries()["knn_close_all"](spark, SF01).select("row_key").distinct().count() == n


def test_every_query_has_a_registered_callable():
    import __spark_entry__ as entry
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= len(o)
