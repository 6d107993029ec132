"""Run a query on Spark and its SQL on DuckDB and compare whole results, order aside."""

from __future__ import annotations

import duckdb
import pandas as pd

from ontime.plans.flights import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _normal(df: pd.DataFrame) -> pd.DataFrame:
    out = df.reindex(columns=sorted(df.columns)).copy()
    for c in out.columns:
        out[c] = out[c].map(lambda v: "\0" if v is None or v != v else repr(v) if isinstance(v, float) else str(v))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def family(kind: str) -> str:
    if kind.startswith("int"):
        return "whole"
    return "real" if kind.startswith("float") else "other"


def differences(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """None when equal, else a short description."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} <> {sorted(right.columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows <> {len(right)} rows"
    for c in left.columns:
        a, b = family(str(left[c].dtype)), family(str(right[c].dtype))
        if a != b and not left[c].isna().any():
            return f"type of {c}: {left[c].dtype} <> {right[c].dtype}"
    a, b = _normal(left), _normal(right)
    if not a.equals(b):
        at = (a != b).any(axis=1)
        return f"{int(at.sum())} rows differ, first\n{a[at].head(3).to_string()}\n{b[at].head(3).to_string()}"
    return None
