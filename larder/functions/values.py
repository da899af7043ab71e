"""Value-producing column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.predicates import is_blank


def as_column(value: Any) -> Column:
    """Columns pass through, everything else becomes a literal."""
    return value if isinstance(value, Column) else F.lit(value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double that is NULL, not an error, for a zero divisor."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def first_match(rules: Iterable[tuple[Column, Any]], default: Any) -> Column:
    """The value of the first rule whose condition holds, else the default."""
    chain = F
    for condition, value in rules:
        chain = chain.when(condition, as_column(value))
    return as_column(default) if chain is F else chain.otherwise(as_column(default))


def clean_text(text: Column) -> Column:
    """Remove every tab and newline."""
    return F.translate(text, "\t\n", "")


def sentinel(value: Column, replacement: Any, bad: Iterable[Any] = ()) -> Column:
    """Replace NULL and every value listed in ``bad``."""
    return F.when(value.isNull() | value.isin(*bad), as_column(replacement)).otherwise(value)


def blank_to(text: Column, replacement: Any) -> Column:
    """Replace NULL and the empty string."""
    return F.when(is_blank(text), as_column(replacement)).otherwise(text)


def minutes_or(text: Column, default: float) -> Column:
    """Minutes held as text; blank gives the default, unreadable text NULL."""
    return F.when(is_blank(text), F.lit(default).cast("float")).otherwise(text.try_cast("float"))
