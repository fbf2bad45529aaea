"""Queries against their SQL on customers whose keys look like something else."""

import duckdb
import pytest

from factloom.operators import extraction
from factloom.queries import QUERIES, SQL


@pytest.mark.parametrize("name,keys", [("pattern_traps", range(1592, 1808)), ("prompts", [1, 4710, 4711, 14711, 47114711])])
def test_equals_sql(spark, tmp_path, name, keys):
    rows = [(k, f"Customer#{k:09d}", "BUILDING") for k in keys]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    c = duckdb.connect()
    c.execute(f"create view customer as select * from '{tmp_path}/customer.parquet/*.parquet'")
    theirs = c.sql(SQL[name])
    assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).select(*theirs.columns).collect())) == sorted(theirs.fetchall())


def test_dollars_are_no_year():
    head = "[k=a|stem=s|chunk=4]\n(rank=1 score=0.5)\n"
    assert extraction.find_nii(head + "net interest income of $1903") == ("$1903", "dollars", "4")
    assert extraction.find_nii(head + "net interest income of 1903") is None


def test_contexts_are_dealt_over_the_cores(spark):
    rows = spark.range(64).selectExpr("id AS k", "'' AS context").coalesce(1)
    assert "RoundRobinPartitioning(16)" in extraction.extracted(rows, "k", 2024)._jdf.queryExecution().executedPlan().toString()
