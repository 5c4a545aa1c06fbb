import importlib.util
import os

import duckdb
import pytest

from docquarry.catalog import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FOLDER = "/root/testdata/sf0.001"
CATALOG = catalog()

_spec = importlib.util.spec_from_file_location("check_sql", os.path.join(ROOT, "tools", "check_sql.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in check.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(CATALOG.sql) == set(CATALOG.runs)


@pytest.mark.parametrize("name", list(CATALOG.runs))
def test_query_equals_sql(spark, duck, name):
    df = CATALOG.runs[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    result = duck.execute(CATALOG.sql[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    mine = check.rows(df.columns, df.collect())
    theirs = check.rows(columns, result.fetchall())
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs):
        assert all(check.close(x, y) for x, y in zip(a, b)), (a, b)


def test_entry(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["key", "doc_count", "avg_price", "max_price"] and df.count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
