"""Relabelling of codes and of whole segments."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import first_match
from larder.functions.values import as_column


def remap_codes(
    df: DataFrame, out: str, rules: Iterable[tuple[Column, Any]], default: Any
) -> DataFrame:
    """Set ``out`` to the value of the first rule that holds, else ``default``.

    Conditions see the input columns, also when ``out`` replaces one of them.
    """
    return df.withColumn(out, first_match(rules, default))


def replicate_segment(df: DataFrame, where: Column, changes: Mapping[str, Any]) -> DataFrame:
    """Every row, plus a second copy with ``changes`` of those where ``where`` holds.

    One narrow pass over the input, where a union would read it twice.
    """
    copies = F.when(where, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    doubled = df.withColumn("_is_copy", F.explode(copies))
    changed = {
        name: F.when(F.col("_is_copy"), as_column(value)).otherwise(F.col(name))
        for name, value in changes.items()
    }
    return doubled.withColumns(changed).select(*df.columns)
