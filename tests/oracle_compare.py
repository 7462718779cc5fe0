"""Spark-vs-DuckDB result comparison used by the tests and tools/check.py.

Columns are sorted by name, rows compared as a multiset; floats are compared
after rounding to 6 decimals, timestamps as naive datetimes.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int,)):
        return (2, float(v))
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return (3, "nan")
        return (2, round(f, 6) + 0.0)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return (4, v.isoformat())
    if isinstance(v, dt.date):
        return (4, dt.datetime(v.year, v.month, v.day).isoformat())
    return (5, str(v))


def normalize(cols: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort()
    return [cols[i] for i in order], out


def compare(spark_df, con, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = spark_df.columns
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    sc, sr = normalize(s_cols, s_rows)
    dc, dr = normalize(d_cols, d_rows)
    res = {"rows_spark": len(sr), "rows_oracle": len(dr), "cols_match": sc == dc,
           "values_match": sr == dr}
    if not res["cols_match"]:
        res["cols"] = (sc, dc)
    elif not res["values_match"]:
        diff_s = [r for r in sr if r not in dr][:3]
        diff_d = [r for r in dr if r not in sr][:3]
        res["diff"] = {"spark_only": diff_s, "oracle_only": diff_d}
    res["ok"] = res["cols_match"] and res["values_match"] and len(sr) == len(dr)
    return res
