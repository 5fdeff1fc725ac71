"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _canonical(df: pd.DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    rows = [tuple(None if pd.isna(v) else str(v) if hasattr(v, "isoformat") else
                  float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
                  for v in row) for row in df[names].astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both have the same columns and rows, otherwise a description."""
    actual = pd.DataFrame([r.asDict() for r in spark_df.collect()], columns=spark_df.columns)
    cursor = con.execute(sql)
    expected = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description])
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    a, e = _canonical(actual), _canonical(expected)
    for x, y in zip(a, e):
        if x != y:
            return f"{sorted(actual.columns)}\nspark  {x}\nduckdb {y}"
    return None
