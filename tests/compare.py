"""Row-by-row comparison of a DataFrame with the result of a SQL text in DuckDB."""

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _cell(value):
    if hasattr(value, "replace") and getattr(value, "tzinfo", None) is not None:
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


# DuckDB type of a column to the Spark type it must have.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp",
    "BOOLEAN": "boolean",
    "DOUBLE": "double",
}


def differences(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types and rows; empty if nothing does."""
    expected = connection.execute(sql)
    described = [(d[0], str(d[1])) for d in expected.description]
    names = [name for name, _ in described]
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} instead of {sorted(names)}"]
    found = []
    types = dict(frame.dtypes)
    for name, kind in described:
        if types[name].replace("timestamp_ntz", "timestamp") != TYPES.get(kind, kind):
            found.append(f"{name} is {types[name]} instead of {kind}")
    got, want = _rows(frame.columns, frame.collect()), _rows(names, expected.fetchall())
    if got != want:
        missing, extra = want - got, got - want
        found.append(
            f"{got.total()} rows instead of {want.total()}; "
            f"missing {list(missing)[:3]}, extra {list(extra)[:3]}"
        )
    return found
