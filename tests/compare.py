"""Comparison of a query with its SQL in DuckDB, without order."""

import glob
import os

import duckdb
import pandas as pd


def connection(directory):
    con = duckdb.connect()
    for file in glob.glob(f"{directory}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    def one(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
            return ""
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return str(bool(x))
        if hasattr(x, "item"):
            x = x.item()
        return repr(round(float(x), 6)) if isinstance(x, int | float) else str(x)

    return sorted(tuple(one(x) for x in row) for row in df[sorted(df.columns)].itertuples(index=False))
