"""Helpers for expressions of built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once.

    Spark may put a column's definition in the place of its name, as when it pushes a
    filter down. Inside a lambda that would compute the value again for
    every element; a lambda's own variable is safe from it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
