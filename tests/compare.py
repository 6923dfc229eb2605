"""Spark result against DuckDB result: names, types and all values."""

from __future__ import annotations

import math
from datetime import datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sortable(row: tuple) -> tuple:
    out = []
    for value in row:
        if value is None:
            out.append((0, ""))
        elif isinstance(value, float):
            out.append((1, "nan" if math.isnan(value) else repr(value + 0.0)))
        elif isinstance(value, datetime):
            out.append((1, value.isoformat()))
        else:
            out.append((1, repr(value)))
    return tuple(out)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {row[0]: row[1] for row in described}
    actual_types = {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema.fields}
    if actual_types != expected_types:
        return [f"schema {actual_types} != {expected_types}"]
    columns = sorted(expected_types)
    quoted = ", ".join(f'"{name}"' for name in columns)
    expected = sorted(map(_sortable, con.execute(f"SELECT {quoted} FROM ({sql})").fetchall()))
    actual = sorted(_sortable(tuple(row)) for row in df.select(*columns).collect())
    if len(actual) != len(expected):
        return [f"{len(actual)} rows != {len(expected)}"]
    return [f"{a} != {e}" for a, e in zip(actual, expected) if a != e][:3]
