"""The registered queries against their SQL, and the registration itself."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator_and_the_pipeline():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_query_equals_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = con.execute(entry.oracle_sql()[name])
    cols, rows = [d[0] for d in got.description], got.fetchall()
    assert sorted(cols) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, rows)[0]
