"""Tagging of text by rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import any_of, is_blank, matches_any

EMPTY = "EMPTY_PREFERENCE"
TAGGED = "AT_LEAST_1"


@dataclass(frozen=True)
class TagRule:
    """When to give a row one tag.

    ``patterns`` are LIKE patterns compared without regard to case. ``blank``
    tags rows whose text is NULL or empty. ``members`` maps other columns to
    values that earn the tag, and ``local`` lists (column, value, pattern): the
    pattern counts only where the column has that value.
    """

    column: str
    label: str
    patterns: tuple[str, ...]
    blank: bool = False
    members: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    local: tuple[tuple[str, str, str], ...] = ()

    def condition(self, text: Column, lowered: Column) -> Column:
        arms = [matches_any(lowered, (pattern.lower() for pattern in self.patterns))]
        arms += [F.col(name).isin(*values) for name, values in self.members.items()]
        arms += [
            (F.col(name) == value) & matches_any(lowered, [pattern.lower()])
            for name, value, pattern in self.local
        ]
        if self.blank:
            arms.append(is_blank(text))
        return any_of(arms)


def tag_by_rules(df: DataFrame, text: str, rules: Sequence[TagRule]) -> DataFrame:
    """Add a column per rule that holds the rule's label, or NULL."""
    lowered = df.withColumn("_lowered", F.lower(text))
    return lowered.withColumns(
        {r.column: F.when(r.condition(F.col(text), F.col("_lowered")), r.label) for r in rules}
    ).drop("_lowered")


def tag_list(
    df: DataFrame,
    text: str,
    tags: Sequence[str],
    out: str,
    check: str | None = None,
    separator: str = ", ",
) -> DataFrame:
    """Join the tags a row has into one text, in the order given.

    Blank ``text`` gives ``EMPTY_PREFERENCE`` instead. ``check`` names a column
    that tells blank rows from the others.
    """
    blank = is_blank(F.col(text))
    columns = {check: F.when(blank, EMPTY).otherwise(TAGGED)} if check else {}
    columns[out] = F.when(blank, EMPTY).otherwise(F.concat_ws(separator, *tags))
    return df.withColumns(columns)


def explode_tags(
    df: DataFrame, tags: Sequence[str], out: str, empty: str = EMPTY, order: Sequence[str] = ()
) -> DataFrame:
    """Distinct rows, one copy per tag a row has, or one ``empty`` copy if none.

    Duplicates are removed before the rows multiply, so the result is distinct
    without a second pass. So are they sorted by ``order``, if given; copies keep it.
    """
    distinct = df.distinct()
    present = F.array_distinct(F.array_compact(F.array(*tags)))
    copies = F.when(F.size("_present") > 0, F.col("_present")).otherwise(F.array(F.lit(empty)))
    return (
        (distinct.orderBy(*order) if order else distinct)
        .withColumn("_present", present)
        .withColumn(out, F.explode(copies))
        .drop("_present")
    )
