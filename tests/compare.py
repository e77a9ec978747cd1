"""Holds a query's rows against its SQL in DuckDB, without regard to order."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (not hasattr(v, "__len__") and pd.isna(v)):
        return "∅"
    if type(v).__name__.startswith("float"):
        return str(round(float(v), 6))
    return str(bool(v)) if type(v).__name__ in ("bool", "bool_") else str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(map(cell, r)) for r in df.itertuples(index=False))


def assert_same(spark_df, sql_df):
    a, b = spark_df.toPandas(), sql_df
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
