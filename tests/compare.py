"""Rows of a query and of its SQL, made comparable."""

import datetime
import glob
import math
import os

import duckdb
import pandas as pd


def plain(v):
    if v is None or v is pd.NaT or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, datetime.datetime):
        return str(pd.Timestamp(v).tz_localize(None))
    return v


def views(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())


def sql_rows(con, sql):
    r = con.sql(sql)
    cols = sorted(r.columns)
    at = [r.columns.index(c) for c in cols]
    return cols, sorted(repr(tuple(plain(x[i]) for i in at)) for x in r.fetchall())
