"""Comparison of a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def differences(df, con, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    columns = sorted(df.columns)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    actual = Counter(tuple(row) for row in df.select(*columns).collect())
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        return (
            f"{sum(extra.values())} extra, {sum(missing.values())} missing of "
            f"{sum(expected.values())}: {list(extra)[:2]} / {list(missing)[:2]}"
        )
    return None if expected else "no rows"
