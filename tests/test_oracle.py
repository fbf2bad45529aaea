"""Every registered query of the library with SQL, against DuckDB on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from factloom.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(x):
    if x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return "null"
    try:
        return repr(round(float(x), 6))
    except (TypeError, ValueError):
        return str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(map(plain, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_plan_runs(spark):
    out = QUERIES["extraction_plan"](spark, SF).toPandas()
    assert len(out) == 15 and set(out.val) >= {"NOT FOUND"}
