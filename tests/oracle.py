"""Comparison of a query with its SQL in DuckDB, independent of order."""

import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    return con


def plain(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return "[" + ",".join(map(plain, v)) + "]"
    if hasattr(v, "asDict"):
        return plain(list(v.asDict().values()))
    return plain(list(v.values())) if isinstance(v, dict) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(plain(r[i]) for i in order) for r in rows)


def same(df, con, sql):
    result = con.execute(sql)
    names = [x[0] for x in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())
