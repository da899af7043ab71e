"""Bill-of-materials roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = " | "


def bom_rollup(
    lines: DataFrame,
    *,
    parents: Sequence[str],
    item: str,
    name: str,
    price: str,
    costs: Mapping[str, Column],
    item_attributes: Mapping[str, Column] | None = None,
    items_out: str = "items",
    names_out: str = "names",
    count_out: str = "item_count",
    missing_out: str = "missing_prices",
) -> DataFrame:
    """Roll item lines up to one row per parent.

    First per item: the ``costs`` (output name -> cost of one line) are summed
    per parent, item, name, whether its price is missing (NULL or 0), and the
    names in ``item_attributes``. Then per parent: costs are summed again,
    distinct items counted, and items, names and unpriced items listed as text,
    all three lists in item order. ``item_attributes`` maps an attribute to the
    value each item adds to the parent's sum of it.

    Repeated lines of an item are combined before the shuffle, so what reaches
    a parent's list is its number of different items, not of lines.
    """
    attributes = item_attributes or {}
    unpriced = F.col(price).isNull() | (F.col(price) == 0)
    per_item = (
        lines.withColumn("_missing", F.when(unpriced, F.col(item)))
        .groupBy(*parents, item, name, "_missing", *attributes)
        .agg(*(F.sum(cost).alias(out) for out, cost in costs.items()))
    )
    entry = F.struct(F.col(item).alias("item"), F.col(name).alias("name"), F.col("_missing").alias("missing"))
    per_parent = per_item.groupBy(*parents).agg(
        F.sort_array(F.collect_list(entry)).alias("_entries"),
        *(F.sum(out).alias(out) for out in costs),
        *(F.sum(added).alias(out) for out, added in attributes.items()),
    )
    entries = F.col("_entries")
    return per_parent.select(
        *parents,
        F.concat_ws(SEPARATOR, entries["item"]).alias(items_out),
        F.concat_ws(SEPARATOR, entries["name"]).alias(names_out),
        F.size(F.array_distinct(F.array_compact(entries["item"]))).cast("long").alias(count_out),
        *costs,
        *attributes,
        F.concat_ws(SEPARATOR, entries["missing"]).alias(missing_out),
    )
