"""Every registered query: plan shape and agreement with its SQL oracle (sf0.001)."""

import os

import pytest

import __spark_entry__ as E
from tabrix.plans import ORACLE_SQL, QUERIES
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad} in plan"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE_SQL[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.count() > 0
