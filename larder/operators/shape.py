"""Projection, stacking and ordering."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.functions.values import as_column


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select ``columns``: output name -> input name or expression."""
    return df.select(
        *((F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items())
    )


def stack(dfs: Iterable[DataFrame], distinct: bool = False) -> DataFrame:
    """Put frames on top of each other by column name.

    A column that a frame lacks is NULL there, with the type it has elsewhere.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    return stacked.distinct() if distinct else stacked


def pad_to_schema(
    df: DataFrame, schema: StructType, constants: Mapping[str, Any] | None = None
) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    A column comes from ``constants`` if named there, else from the frame, else
    it is a NULL of the schema's type.
    """
    constants, given = constants or {}, set(df.columns)

    def column(name: str) -> Column:
        if name in constants:
            return as_column(constants[name])
        return F.col(name) if name in given else F.lit(None)

    return df.select(*(column(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def distinct_ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows, sorted by ``columns``.

    Rows that tie are ordered by a hash of the whole row. That leaves the asked
    order intact and lets the range partitioner cut inside one sort key, so a
    key with many rows does not end up in a single task.
    """
    return ordered(df.distinct(), columns)


def ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sort by ``columns``, ties by a hash of the whole row."""
    return df.orderBy(*columns, F.xxhash64(*df.columns))


def ranged(df: DataFrame, columns: Sequence[str], tie: str) -> DataFrame:
    """Rows dealt to tasks by ranges of ``columns``, ties by a hash of the whole row, named ``tie``.

    Equal rows meet, so neither to remove repeated rows nor to sort by ``columns`` and ``tie``
    takes Spark a further shuffle.
    """
    return df.withColumn(tie, F.xxhash64(*df.columns)).repartitionByRange(*columns, tie)
