"""Every registered query against its SQL oracle (DuckDB) on sf0.001, plus
plan properties: no Python UDF anywhere, filters and columns pushed to scans."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from stratum.plans import quality_queries, testdata, warehouse_queries

SF = os.environ.get("STRATUM_TEST_SF", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]

NAMES = sorted([*testdata.QUERIES, *warehouse_queries.QUERIES, *quality_queries.QUERIES])

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("f", repr(v + 0.0))
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat())
    return ("v", str(v))


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    cur = duck.execute(sql)
    cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, want)


@pytest.mark.parametrize("name", NAMES)
def test_no_python_udf_in_plan(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for udf_node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert udf_node not in plan


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "order_id" in df.columns


def test_scan_pruning_and_pushdown(spark):
    plan = queries()["incremental_upsert"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    plan = queries()["dq_unique"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan
