"""Queries with a SQL counterpart, on whole tables, by value."""

import math
import os

import duckdb
import pandas as pd
import pytest

from duolex.llm.oracles import all_oracles
from duolex.llm.queries import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for file in os.listdir(small):
        con.execute(f"create view {file.split('.')[0]} as select * from '{small}/{file}'")
    return con


def _rows(frame):
    def cell(x):
        if x is pd.NA or isinstance(x, float) and math.isnan(x):
            return None
        return round(float(x), 6) if isinstance(x, (int, float)) or hasattr(x, "dtype") else x

    frame = frame[sorted(frame.columns)]
    return sorted(repr([cell(x) for x in row]) for row in frame.itertuples(index=False, name=None))


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, duck, small):
    got, want = QUERIES[name](spark, small).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
