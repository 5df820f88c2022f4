"""Runs registered queries beside their SQL and compares the rows as multisets."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

import sample_tables as sample


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sample.NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows(columns: list[str], found) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in found)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when the results match, else what differs."""
    df = query(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want, got = rows(names, result.fetchall()), rows(df.columns, df.collect())
    if want == got:
        return None
    extra, lost = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"{got.total()} rows != {want.total()}; only in Spark {extra}; only in SQL {lost}"
