"""Boolean column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of the conditions; never true when there are none."""
    return reduce(or_, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    """AND of the conditions; always true when there are none."""
    return reduce(and_, conditions, F.lit(True))


def is_blank(text: Column) -> Column:
    """True for NULL and for the empty string."""
    return text.isNull() | (text == "")


def matches(text: Column, pattern: str) -> Column:
    """SQL LIKE, written with the cheapest equivalent expression.

    A pattern that is plain text between ``%`` signs becomes ``contains``,
    ``startswith``, ``endswith`` or ``=``, all of which Spark can push to a
    Parquet scan or evaluate without a regular expression. Anything with an
    inner ``%`` or a ``_`` stays a LIKE. NULL text gives NULL, as LIKE does.
    """
    body = pattern.strip("%")
    if not body or any(mark in body for mark in "%_\\"):
        return text.like(pattern)
    open_start, open_end = pattern.startswith("%"), pattern.endswith("%")
    if open_start and open_end:
        return text.contains(body)
    if open_start:
        return text.endswith(body)
    if open_end:
        return text.startswith(body)
    return text == body


def matches_any(text: Column, patterns: Iterable[str]) -> Column:
    """True when the text is LIKE at least one of the patterns."""
    return any_of(matches(text, pattern) for pattern in patterns)
