"""Spark-vs-DuckDB result comparison used by the tests and by hand.

Results are compared as multisets of rows after normalising types (decimal
and float to float, date/timestamp to ISO text), with column names sorted,
exactly as an order-insensitive value hash would see them.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (decimal.Decimal, float)):
        f = float(v)
        return None if math.isnan(f) else f
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], [columns[i] for i in order]


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows, s_names = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    res = con.sql(sql)
    d_rows, d_names = rows_of(res.columns, res.fetchall())
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "columns_match": s_names == d_names}
    cs, cd = Counter(s_rows), Counter(d_rows)
    out["values_match"] = cs == cd
    if cs != cd:
        out["only_spark"] = list((cs - cd).elements())[:3]
        out["only_oracle"] = list((cd - cs).elements())[:3]
    if s_names != d_names:
        out["spark_columns"], out["oracle_columns"] = s_names, d_names
    return out


def compare_pandas(spark_df, con, sql: str) -> dict:
    """The same comparison through pandas (Spark toPandas vs DuckDB .df()):
    dtype kinds per column and stringified rows must agree."""
    import pandas as pd

    def canon(df):
        df = df[sorted(df.columns)]
        def cell(v):
            if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
                return "None"
            return str(v)
        return sorted("|".join(cell(v) for v in r) for r in df.itertuples(index=False))

    s, d = spark_df.toPandas(), con.sql(sql).df()
    kinds_s = {c: s[c].dtype.kind for c in s.columns}
    kinds_d = {c: d[c].dtype.kind for c in d.columns}
    return {"kinds_match": kinds_s == kinds_d, "values_match": canon(s) == canon(d),
            "kinds": {c: (kinds_s.get(c), kinds_d.get(c)) for c in set(kinds_s) | set(kinds_d)
                      if kinds_s.get(c) != kinds_d.get(c)}}
