"""Every catalogued query against its SQL, on the smallest tables."""

import pytest

from driftline.catalog import load
from tests.compare import difference, duck, duck_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"
CATALOG = load()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


# joined with a single row: totals, edges, limits
ONE_ROW = {
    "class_balance", "conditional_returns", "error_thresholds", "recent_rows", "recent_rows_fallback",
    "stability_verdicts", "value_histogram",
}


def check_joins(df, name):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text or name in ONE_ROW


@pytest.mark.parametrize("name", sorted(n for n, q in CATALOG.items() if q.sql))
def test_matches_sql(spark, con, name):
    q = CATALOG[name]
    df = q.run(spark, FOLDER)
    assert difference(spark_rows(df), duck_rows(con, q.sql)) is None
    check_joins(df, name)


@pytest.mark.parametrize("name", sorted(n for n, q in CATALOG.items() if not q.sql))
def test_runs(spark, name):
    df = CATALOG[name].run(spark, FOLDER)
    assert df.columns and df.count() > 0
    check_joins(df, name)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
