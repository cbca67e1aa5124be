"""Comparing a query with its SQL on the same tables."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def _plain(v):
    if v is None or v != v:
        return ""
    return f"{float(v):.6f}" if not isinstance(v, (str, bool)) and hasattr(v, "__float__") else str(v)


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(map(tuple, frame[columns].map(_plain).values.tolist()))


def sql_rows(sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return rows(con.sql(sql).df())
