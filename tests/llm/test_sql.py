"""The operators with a SQL twin return the same table as DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

from lagfield.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for name in os.listdir(sf):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf}/{name}'")
    return c


def tidy(df, dates):
    out = {}
    for c in sorted(df.columns):
        if c in dates:
            out[c] = pd.to_datetime(df[c]).astype("datetime64[s]").astype(str)
        elif pd.api.types.is_float_dtype(df[c]):
            out[c] = df[c].round(6)
        else:
            out[c] = df[c].map(lambda v: None if pd.isna(v) else str(v))
    return pd.DataFrame(out).sort_values(sorted(df.columns), na_position="first").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, con, name):
    frame = QUERIES[name](spark, sf)
    dates = [f.name for f in frame.schema if f.dataType.simpleString() in ("date", "timestamp", "timestamp_ntz")]
    got, want = tidy(frame.toPandas(), dates), tidy(con.execute(SQL[name]).df(), dates)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
