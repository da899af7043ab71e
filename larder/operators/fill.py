"""Cleaning and filling of columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import clean_text, minutes_or, ratio, sentinel


def clean_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Remove tabs and newlines from text columns."""
    return df.withColumns({name: clean_text(F.col(name)) for name in columns})


def sentinel_fill(df: DataFrame, column: str, replacement: Any, bad: Iterable[Any] = ()) -> DataFrame:
    """Replace NULL and the ``bad`` values of a column."""
    return df.withColumn(column, sentinel(F.col(column), replacement, bad))


def duration_total(df: DataFrame, parts: Sequence[str], out: str, default: float = 99) -> DataFrame:
    """Sum of minutes held as text; each blank part counts as ``default``."""
    first, *rest = (minutes_or(F.col(part), default) for part in parts)
    return df.withColumn(out, sum(rest, first))


def hierarchical_mean_fill(
    df: DataFrame,
    columns: Mapping[str, str],
    groups: Sequence[str],
    default: float,
    flags: Mapping[str, str] | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Fill NULLs with the mean of the row's group, trying ``groups`` in order.

    ``columns`` maps a column to the name of its filled version and ``flags`` a
    column to the name of a 0/1 column that says its own value was missing. When
    no group has a mean the ``default`` is used. NULL is a group like any other.
    ``weight`` is how many rows a row counts for in the means, one if omitted.

    Sums and counts for all columns are taken once per combination of groups,
    combining on the map side, and every group's means come from that small
    table; rows then look their means up by null-safe joins. A group of any size
    is thus never brought together, as a window over it would do. The frame is
    evaluated more than once, so stage it first when it is costly.
    """
    row_level = df.withColumns(
        {name: F.when(F.col(c).isNull(), 1).otherwise(0) for c, name in (flags or {}).items()}
    )
    rows = F.lit(1) if weight is None else weight
    sums = {c: (f"_sum_{i}", f"_count_{i}") for i, c in enumerate(columns)}
    combined = df.groupBy(*groups).agg(
        *(F.sum(F.col(c) * rows).alias(s) for c, (s, _) in sums.items()),
        *(F.sum(F.when(F.col(c).isNotNull(), rows)).alias(n) for c, (_, n) in sums.items()),
    )
    filled = row_level
    for level, group in enumerate(groups):
        key = f"_group_{level}"
        means = combined.groupBy(F.col(group).alias(key)).agg(
            *(ratio(F.sum(s), F.sum(n)).alias(f"_mean_{level}_{c}") for c, (s, n) in sums.items())
        )
        filled = filled.join(means, F.col(group).eqNullSafe(F.col(key)), "left")
    values = {
        out: F.coalesce(c, *(f"_mean_{level}_{c}" for level in range(len(groups))), F.lit(default))
        for c, out in columns.items()
    }
    kept = [name for name in row_level.columns if name not in values]
    return filled.select(*kept, *(value.alias(out) for out, value in values.items()))
