"""Run SQL text on the test tables in DuckDB and compare its rows with a DataFrame's rows."""

from __future__ import annotations

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return columns, result.fetchall()


def _plain(value):
    if isinstance(value, float) and pd.isna(value):
        return None
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted, as texts."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(_plain(row[i])) for i in order) for row in rows)


def assert_same_rows(df: DataFrame, sql: str, sf_dir: str) -> int:
    columns, expected = duck_rows(sql, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want = canonical(columns, expected)
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, different[:3]
    return len(got)
