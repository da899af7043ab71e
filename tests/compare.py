"""Comparison of a Spark result with DuckDB's, column by column and row by row."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# Type names of the two engines that hold the same values.
SAME_TYPE = {
    "string": {"VARCHAR"},
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "float": {"FLOAT"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp": {"TIMESTAMP", "TIMESTAMP WITH TIME ZONE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def open_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (1, repr(value + 0.0))
    if hasattr(value, "isoformat"):
        return (1, value.replace(tzinfo=None).isoformat(sep=" "))
    return (1, repr(value))


def rows_of(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def differences(spark_df: DataFrame, connection, sql: str) -> list[str]:
    """What differs between the results, empty when nothing does."""
    cursor = connection.execute(sql)
    types = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    found = []
    names = spark_df.columns
    if sorted(names) != sorted(types):
        return [f"columns {sorted(set(names) ^ set(types))}"]
    for name, kind in spark_df.dtypes:
        theirs = types[name]
        same = SAME_TYPE.get(kind)
        if theirs not in same if same else theirs.lower() != kind:
            found.append(f"type of {name}: {kind} and {theirs}")
    actual = spark_df.collect()
    left, right = rows_of(names, actual), rows_of(list(types), expected)
    if len(left) != len(right):
        found.append(f"rows {len(left)} and {len(right)}")
    if left != right:
        only_left = sorted(set(left) - set(right))[:2]
        only_right = sorted(set(right) - set(left))[:2]
        found.append(f"only in Spark {only_left}; only in DuckDB {only_right}")
    if not left:
        found.append("no rows")
    return found
