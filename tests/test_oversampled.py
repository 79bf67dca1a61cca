"""Oversampling covers all training rows, also where fitting takes a draw of them."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from stayline.plans.training import Pipeline


@pytest.mark.parametrize("name", ["smote_rows", "smote_balance"])
def test_fit_rows_do_not_cut_the_oversampling(name, spark, sf, pipe, monkeypatch):
    small = Pipeline(pipe.customers, pipe.settings, fit_rows=200)
    monkeypatch.setattr(entry, "_pipe", lambda s, d: small)
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    got = entry._own_queries()[name](spark, sf).toPandas()
    want = con.execute(entry.oracle_queries.oracle_sql()[name]).df()[list(got.columns)]
    keys = [c for c in ("customer_id", "stage", "label") if c in got.columns]
    got, want = (x.sort_values(keys, ignore_index=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    assert small.balanced.count() < small.oversampled.count()
