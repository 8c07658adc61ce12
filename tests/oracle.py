"""Compares a query with its SQL, without regard to the order of rows."""

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "year"):
        return str(pd.Timestamp(v).date())
    return repr(float(v)) if isinstance(v, (int, float)) else str(v)


def rows(df):
    return sorted(tuple(map(_plain, r)) for r in df[sorted(df.columns)].astype(object).values.tolist())


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
