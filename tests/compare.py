"""Rows of a Spark query and of its SQL twin in a form that can be compared."""

import glob
import os

import duckdb
import pandas as pd


def _plain(value):
    if value is None or value is pd.NA or value is pd.NaT:
        return None
    if hasattr(value, "tolist"):
        value = value.tolist()
    if not isinstance(value, float):
        return value
    # a column of whole numbers with nulls is one of floats in one of the two
    return None if value != value else int(value) if value.is_integer() else round(value, 6)


def rows(pdf):
    columns = sorted(pdf.columns)
    return columns, sorted(repr(tuple(map(_plain, r))) for r in pdf[columns].itertuples(index=False))


def twin(sql, sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con.execute(sql).df()
