"""Rows of a query against rows of its SQL in DuckDB."""

from __future__ import annotations

import os
from typing import Any

import duckdb
from pyspark.sql import DataFrame


def plain(x: Any) -> Any:
    if isinstance(x, float):
        return round(x, 6)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def ordered(rows: list, columns: list[str]) -> list[tuple]:
    at = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def assert_same(df: DataFrame, sql: str, folder: str) -> None:
    with duckdb.connect() as c:
        for f in os.listdir(folder):
            c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{f}'")
        found = c.execute(sql)
        columns, rows = [d[0] for d in found.description], found.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.collect(), df.columns) == ordered(rows, columns)
