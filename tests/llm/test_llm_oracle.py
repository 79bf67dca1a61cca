"""The training-data queries with SQL return what DuckDB returns; every one of them is registered once."""

import re
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from stayline.llm import queries


def test_one_query_per_operator():
    names = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.queries())
    assert names == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(name, spark, sf):
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    got = queries.queries()[name](spark, sf).toPandas()
    want = con.execute(queries.oracle_sql()[name]).df()[list(got.columns)]
    got, want = (x.sort_values(list(got.columns), ignore_index=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
