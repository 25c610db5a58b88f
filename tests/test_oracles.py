"""Every query with a SQL counterpart, on whole tables, by value."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from duolex.plans.catalog import all_queries
from duolex.plans.oracles import all_oracles

TABLES = "documents benchmark labels conversations".split()
# Subpackages that may be left out are tested on their own.
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    return con


def _cell(x):
    if x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return None
    return x if isinstance(x, str) else float(x) + 0.0


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(repr([_cell(x) for x in row]) for row in frame.itertuples(index=False, name=None))


def test_oracles_name_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, duck, small):
    got, want = QUERIES[name](spark, small).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_entry_counts_fall(spark):
    for r in contract.entry(spark).collect():
        assert r["Original"] >= r["Step_1"] == r["Step_2"] >= r["Step_3(1)"]
        assert r["Step_4"] >= r["Step_3(2)"] >= r["Step_5"]
