"""Plan-shape checks for the scale properties the design relies on."""

from conftest import SF01
from vigil.plans import queries as Q


def plan(df) -> str:
    """The plan that ran (reused exchanges are known only then)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_flagship_prunes_columns_and_scans_once(spark):
    p = plan(Q.confusion_rates(spark, SF01))
    assert p.count("documents.parquet") == 1            # scored rows feed one aggregate
    assert "struct<doc_id:bigint,n_chars:bigint>" in p


def test_report_reads_lineitem_once(spark):
    """Class rows and summary rows come from one aggregate, its exchange reused."""
    p = plan(Q.class_report(spark, SF01))
    assert p.count("lineitem.parquet") == 1 and "ReusedExchange" in p
