"""Run queries in Spark and their SQL in DuckDB and compare values."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'") if glob.glob(p) else None
    return con


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "~"
    if isinstance(x, bool):
        return str(x)
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, float):
        return f"{x:.9g}" if x != int(x) or abs(x) > 1e15 else str(int(x))
    return str(int(x)) if not isinstance(x, (str, bytes, bool)) and hasattr(x, "as_integer_ratio") else str(x)


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in data)


def differ(spark, con, query, sql: str, sf_dir: str) -> str:
    df = query(spark, sf_dir)
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} against {sorted(rel.columns)}"
    a, b = rows(df.columns, [tuple(r) for r in df.collect()]), rows(rel.columns, rel.fetchall())
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return f"{len(a)} rows against {len(b)}; only here {only_a}, only in SQL {only_b}"
