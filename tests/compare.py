"""Order-free comparison of a Spark result with DuckDB's."""

import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    if isinstance(v, int):
        return str(v)
    try:
        f = float(v)
        return str(int(f)) if f == int(f) and abs(f) < 1e15 else f"{f:.5f}"
    except (TypeError, ValueError, OverflowError):
        return str(v)


def rows(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def check(df, con, sql):
    got = rows([tuple(r) for r in df.collect()], df.columns)
    answer = con.execute(sql)
    names = [c[0] for c in answer.description]
    want = rows(answer.fetchall(), names)
    assert sorted(df.columns) == sorted(names)
    assert got == want
