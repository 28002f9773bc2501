"""Compare a Spark result with the answer of the equivalent SQL, as bags of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")


def duck(root: str, files: str = "") -> duckdb.DuckDBPyConnection:
    """Views over the tables below ``root``; ``files`` is a pattern for tables that are folders."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet{files}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    ours, theirs = bag(df.columns, df.collect()), bag(names, result.fetchall())
    if ours != theirs:
        return f"only ours {list((ours - theirs).items())[:3]}, only theirs {list((theirs - ours).items())[:3]}"
    return None
