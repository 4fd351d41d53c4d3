"""Compares a query with its SQL in DuckDB."""

import glob
import os

import duckdb
import pandas as pd


def views(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f if os.path.isfile(f) else f + '/*.parquet'}'")
    return c


def rows(df: pd.DataFrame):
    def cell(v):
        if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        if isinstance(v, bool) or str(v) in ("True", "False"):
            return bool(v)
        if hasattr(v, "__float__") and not isinstance(v, str):
            return float(f"{float(v):.9g}")
        return v

    cols = sorted(df.columns)
    return cols, sorted((tuple(cell(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)), key=repr)


def same(spark, fn, sql, sf_dir):
    got, want = rows(fn(spark, sf_dir).toPandas()), rows(views(sf_dir).sql(sql).df())
    assert got[0] == want[0], (got[0], want[0])
    assert len(got[1]) == len(want[1]), (len(got[1]), len(want[1]))
    bad = [(a, b) for a, b in zip(got[1], want[1], strict=True) if a != b]
    assert not bad, (len(bad), bad[:3])
