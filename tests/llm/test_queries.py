"""The text queries on the smallest tables, against DuckDB where there is SQL."""

import os
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

DATA = Path(os.environ.get("RODAJE_TESTDATA", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")

from rodaje.llm import queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    got = queries.queries()[name](spark, str(DATA)).toPandas()
    assert len(got.columns) and len(got)
    sql = queries.oracle_sql().get(name)
    if sql:
        con = duckdb.connect()
        for f in DATA.iterdir():
            con.execute(f"create view {f.stem} as select * from '{f}'")
        want = con.sql(sql).df()
        key = sorted(want.columns)
        assert sorted(got.columns) == key
        text = lambda df: sorted(map(tuple, df[key].astype(str).values.tolist()))
        assert text(got) == text(want)
