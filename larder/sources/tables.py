"""Binding of the plans' input roles to tables or files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from larder.sources.schemas import SOURCE_SCHEMAS, WEEK

Tables = Mapping[str, DataFrame]


def read_tables(
    spark: SparkSession, names: Mapping[str, str], file_format: str | None = None
) -> dict[str, DataFrame]:
    """Open what ``names`` maps each role of ``SOURCE_SCHEMAS`` to.

    Values are catalog names, or paths when ``file_format`` is given.
    """
    unknown = set(names) - set(SOURCE_SCHEMAS)
    if unknown:
        raise ValueError(f"unknown table roles: {sorted(unknown)}")
    if file_format:
        return {role: spark.read.format(file_format).load(path) for role, path in names.items()}
    return {role: spark.table(name) for role, name in names.items()}


def conform(tables: Tables, week_column: str = WEEK) -> dict[str, DataFrame]:
    """Each role's columns in the role's types; other columns are pruned away.

    ``week_column`` is what the given tables call their week column.
    """
    outside = {WEEK: week_column}
    return {
        role: df.selectExpr(
            *(
                f"cast(`{outside.get(f.name, f.name)}` as {f.dataType.simpleString()}) as {f.name}"
                for f in SOURCE_SCHEMAS[role].fields
            )
        )
        for role, df in tables.items()
    }
