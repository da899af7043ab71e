"""Row filters driven by rule lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import all_of, any_of, matches


def rule_filter(df: DataFrame, rules: Iterable[Iterable[Column]]) -> DataFrame:
    """Keep rows for which all conditions of at least one rule hold."""
    return df.filter(any_of(all_of(rule) for rule in rules))


def exclude_patterns(
    df: DataFrame,
    like: Mapping[str, Iterable[str]] | None = None,
    values: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Drop rows that match a pattern or hold a listed value.

    As with SQL ``NOT LIKE`` and ``NOT IN``, a NULL in any named column drops
    the row as well.
    """
    kept = [
        ~matches(F.col(name), pattern)
        for name, patterns in (like or {}).items()
        for pattern in patterns
    ]
    kept += [~F.col(name).isin(*listed) for name, listed in (values or {}).items()]
    return df.filter(all_of(kept))
