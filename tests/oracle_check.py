"""Run a query and its SQL, and compare them row by row."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return f"{value.normalize():f}"
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return value.isoformat()
    return str(value)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want, got = rows(names, cursor.fetchall()), rows(df.columns, df.collect())
    if want == got:
        return None
    extra = [r for r in got if r not in set(want)][:3]
    missing = [r for r in want if r not in set(got)][:3]
    return f"{len(got)} rows, want {len(want)}; extra {extra}; missing {missing}"
