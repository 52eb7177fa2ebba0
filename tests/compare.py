"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb

# Spark type name -> DuckDB type name, for the types the queries return.
DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def duck_type(spark_type: str) -> str:
    return spark_type.upper() if spark_type.startswith("decimal") else DUCK_TYPES[spark_type]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return str(value)
    return value.isoformat() if isinstance(value, datetime) else value


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(df, con, sql) -> int:
    """Same names, types and rows; returns the row count."""
    result = con.sql(sql)
    assert sorted(df.columns) == sorted(result.columns)
    expected_types = dict(zip(result.columns, map(str, result.types)))
    actual_types = {name: duck_type(t) for name, t in df.dtypes}
    assert actual_types == expected_types
    expected = bag(result.fetchall(), result.columns)
    actual = bag(df.collect(), df.columns)
    assert actual.total() == expected.total()
    assert actual == expected
    return actual.total()
