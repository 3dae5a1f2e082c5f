"""Every query with a SQL twin returns the same table as DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from lagfield.plans.catalog import QUERIES
from lagfield.plans.oracles import SQL


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for name in os.listdir(sf):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf}/{name}'")
    return c


def tidy(df: pd.DataFrame) -> pd.DataFrame:
    out = {}
    for c in sorted(df.columns):
        s = df[c]
        out[c] = s.astype("float64") if pd.api.types.is_numeric_dtype(s) else s.map(lambda v: None if pd.isna(v) else str(v))
    df = pd.DataFrame(out)
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def test_names():
    assert set(SQL) <= set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, con, name):
    frame = QUERIES[name](spark, sf)
    dates = [f.name for f in frame.schema if f.dataType.simpleString() in ("date", "timestamp", "timestamp_ntz")]
    got = tidy(frame.toPandas())
    want = tidy(con.execute(SQL[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    for c in got.columns:
        if got[c].dtype == "float64" and want[c].dtype == "float64":
            pd.testing.assert_series_equal(got[c], want[c], atol=2e-6, rtol=1e-9)
        elif c in dates:
            assert (pd.to_datetime(got[c]) == pd.to_datetime(want[c])).all()
        else:
            assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c
