"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

SF_ROOT = Path("/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_df, con, sql) -> str | None:
    """None when names and all rows agree, else a short description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    actual = spark_df.collect()
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    mine, theirs = _sorted_rows(spark_df.columns, actual), _sorted_rows(names, expected)
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b or [type(v) for v in a] != [type(v) for v in b]]
    return f"{len(wrong)} rows differ, first {wrong[:2]}"[:1500] if wrong else None
