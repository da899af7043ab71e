"""Preference tags of pool recipes, menu slots and demanded recipes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from larder.operators import TagRule, tag_by_rules, tag_list
from larder.plans import fixed_values as fixed
from larder.plans.schema import CHECK_COLUMN, LIST_COLUMN

TAG_COLUMNS = [column for column, _ in fixed.TAGS]


def _rules(extra_texts=None, members=None) -> list[TagRule]:
    """The common tag rules with a branch's own texts and member values."""
    extra_texts, members = extra_texts or {}, members or {}

    def local(column):
        ending = fixed.LOCAL_TAG_ENDINGS.get(column)
        return (("country", fixed.LOCAL_TAG_COUNTRY, f"%{ending}"),) if ending else ()

    return [
        TagRule(
            column,
            label,
            tuple(f"%{text}%" for text in (*fixed.TAG_TEXTS[column], *extra_texts.get(column, ()))),
            blank=column == "Classic",
            members=members.get(column, {}),
            local=local(column),
        )
        for column, label in fixed.TAGS
    ]


POOL_RULES = _rules(
    fixed.POOL_TAG_TEXTS, {"Pescatarian": {"mainprotein": fixed.POOL_PESCATARIAN_PROTEINS}}
)
SLOT_RULES = _rules(fixed.SLOT_TAG_TEXTS)
DEMAND_RULES = _rules()


def with_preferences(df: DataFrame, rules: list[TagRule]) -> DataFrame:
    """Add a column per tag, the check label and the list of tags."""
    tagged = tag_by_rules(df, "preference", rules)
    return tag_list(tagged, "preference", TAG_COLUMNS, LIST_COLUMN, CHECK_COLUMN)
