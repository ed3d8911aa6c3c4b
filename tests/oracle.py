"""Compares a query with its SQL twin, run by DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _text(value) -> str:
    """One form for values that only differ by type: pandas turns integers with gaps into floats."""
    if value is None or pd.isna(value):
        return "NULL"
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    return str(value)


def _sorted_values(frame: pd.DataFrame) -> list[tuple]:
    rows = frame[sorted(frame.columns)].astype(object).itertuples(index=False, name=None)
    return sorted(tuple(map(_text, row)) for row in rows)


def differences(spark_frame, sql: str, con: duckdb.DuckDBPyConnection) -> str | None:
    """What differs, or None."""
    ours, theirs = spark_frame.toPandas(), con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    a, b = _sorted_values(ours), _sorted_values(theirs)
    for x, y in zip(a, b):
        if x != y:
            return f"{x} / {y}"
    return None
