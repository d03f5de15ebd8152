"""Every query that has SQL is compared with DuckDB over the smallest tables."""

import math
import os
from pathlib import Path

import pandas as pd
import pytest

duckdb = pytest.importorskip("duckdb")

DATA = Path(os.environ.get("RODAJE_TESTDATA", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")

from rodaje.plans import registry  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in DATA.iterdir():
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def cell(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, str):
        return v
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return repr(float(v))


def normal(df):
    return sorted((tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    ours, theirs = registry.queries()[name](spark, str(DATA)).toPandas(), duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours) == normal(theirs)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    df = registry.queries()[name](spark, str(DATA))
    assert df.columns and df.count() >= 0
