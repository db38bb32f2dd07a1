"""Comparing a query with its SQL in DuckDB."""

import os

import duckdb


def tables(sf_dir):
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        c.sql(f"create view {f.split('.')[0]} as select * from '{sf_dir}/{f}'")
    return c


def values(df):
    df = df[sorted(df.columns)]
    df = df.astype(object).where(df.notna(), None)
    return list(df.columns), sorted(df.map(lambda v: tuple(v) if hasattr(v, "tolist") and hasattr(v, "__len__") else v).astype(str).itertuples(index=False, name=None))
