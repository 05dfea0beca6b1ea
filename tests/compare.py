"""Comparison of a Spark result with the same query in DuckDB, row for row."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs; empty if columns and all rows agree."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return [f"columns: {sorted(df.columns)} instead of {sorted(columns)}"]
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    want = bag(columns, expected)
    if got == want:
        return []
    missing, extra = list((want - got).items())[:3], list((got - want).items())[:3]
    return [f"rows {sum(got.values())} instead of {sum(want.values())}", f"missing {missing}", f"extra {extra}"]
