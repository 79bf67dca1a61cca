"""Every query with SQL returns what DuckDB returns on the same tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry._own_queries(), entry.oracle_queries.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    exact = [c for c in df.columns if df[c].dtype.kind != "f"]
    order = exact + [c for c in df.columns if c not in exact]
    return df.sort_values(order).reset_index(drop=True)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, sf, duck):
    got = _sorted(QUERIES[name](spark, sf).toPandas())
    want = _sorted(duck.execute(SQL[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 0
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, sf):
    df = QUERIES[name](spark, sf)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)
