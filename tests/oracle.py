"""Runs a check query on Spark and its SQL on DuckDB, and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
from collections import Counter

import duckdb

from evolve.queries.registry import TABLES


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(folder, name)}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both agree, else what differs."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} against {sorted(relation.columns)}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    only_ours, only_theirs = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return f"{ours.total()} rows against {theirs.total()}; ours {only_ours}; sql {only_theirs}"
