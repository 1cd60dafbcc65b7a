"""Runs a query and its SQL on the same Parquet files and compares the tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "item"):
        return _plain(value.item())
    return value


def _table(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda r: [str(v) for v in r])


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both tables are equal, otherwise what differs."""
    got_cols, got = _table(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_cols, want = _table([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} against {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}; first {got[:2]} against {want[:2]}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    types = [
        (c, type(a), type(b))
        for row_a, row_b in zip(got, want)
        for c, a, b in zip(got_cols, row_a, row_b)
        if type(a) is not type(b) and a is not None and b is not None
    ]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]}"
    return f"types differ: {types[0]}" if types else None
