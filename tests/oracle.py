"""Spark result against SQL on the same tables, columns by name, rows in any order."""

import math
import os

import duckdb


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return str(v)


def views(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in os.listdir(folder):
        path = f"{folder}/{f}" + ("/*" if os.path.isdir(f"{folder}/{f}") else "")
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(df) -> list:
    names = sorted(df.columns)
    return sorted(tuple(_cell(r[n]) for n in names) for r in df.collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], list]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_cell(r[i]) for i in order) for r in cur.fetchall())
