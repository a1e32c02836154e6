"""Compares a registered query with its SQL on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(frame: pd.DataFrame, columns: list[str]) -> list[tuple]:
    plain = [
        tuple(None if pd.isna(v) else v for v in row)
        for row in frame[columns].astype(object).itertuples(index=False, name=None)
    ]
    return sorted(plain, key=repr)


def compare(spark_frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when rows are equal, else what differs."""
    got = spark_frame.toPandas()
    want = con.execute(sql).df()
    columns = sorted(got.columns)
    if columns != sorted(want.columns):
        return f"columns {columns} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    types = {c: (str(got[c].dtype), str(want[c].dtype)) for c in columns}
    a, b = _rows(got, columns), _rows(want, columns)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, first {columns}: {bad[0]}; types {types}"
    return None
