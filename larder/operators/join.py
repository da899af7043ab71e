"""Chained enrichment joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import all_of

#: Rows over which a fan-out join spreads what has no match.
SPARE = 256


def enrich(
    fact: DataFrame,
    dimensions: Sequence[tuple[DataFrame, str | Sequence[str] | Column, str]],
) -> DataFrame:
    """Join the dimensions on to the fact, one after the other.

    Each entry is (frame, join columns or condition, join type). The type
    ``left_many`` is a left join on columns to a frame that may hold any number
    of rows for one key (see ``fan_out_join``). Several matches for one fact row give
    several rows. No side is forced to be broadcast: Spark does so where it
    measures the side to be under the session's limit, and splits skewed
    partitions of the sort-merge joins that remain.
    """
    joined = fact
    for dimension, on, how in dimensions:
        if how == "left_many":
            if isinstance(on, Column):
                raise TypeError("left_many joins on columns of the same name, not on a condition")
            joined = fan_out_join(joined, dimension, [on] if isinstance(on, str) else on)
        else:
            by = on if isinstance(on, (str, Column)) else list(on)
            joined = joined.join(dimension, by, how)
    return joined


def fan_out_join(
    fact: DataFrame, many: DataFrame, on: Sequence[str], present: Column | None = None
) -> DataFrame:
    """Left join to a frame in which a key may have a large share of all rows.

    Adaptive execution never splits the right side of a left join. So this is an
    inner join, of which either side can be split: fact rows without a match are
    sent to spare rows without values instead, spread over ``SPARE`` of them. Whether a row
    has a match follows from the distinct keys of ``many``, one row per key, or
    from ``present``, a condition on the fact, where the caller knows it. The
    fact is evaluated once, so a chain of these joins stays linear in its length.
    """
    on = list(on)
    names = {column: f"_many_{column}" for column in on}
    rows = many.dropna(subset=on).withColumnsRenamed(names)
    if present is None:
        keys = rows.select(*names.values()).distinct().withColumn("_many_present", F.lit(True))
        same = all_of(F.col(column) == F.col(name) for column, name in names.items())
        fact = fact.join(keys, same, "left").drop(*names.values())
        present = F.col("_many_present")
    known = F.coalesce(present, F.lit(False)) & all_of(F.col(column).isNotNull() for column in on)
    spread = F.pmod(F.xxhash64(*fact.columns), F.lit(SPARE))
    sent = fact.withColumns(
        {f"_fact_{column}": F.when(known, F.col(column)) for column in on}
        | {"_fact_spare": F.when(~known, spread)}
    )
    spares = fact.sparkSession.range(SPARE).withColumnRenamed("id", "_many_spare")
    complete = rows.unionByName(spares, allowMissingColumns=True)
    same = all_of(
        F.col(f"_fact_{column}").eqNullSafe(F.col(f"_many_{column}")) for column in [*on, "spare"]
    )
    helpers = [f"_{side}_{column}" for side in ("fact", "many") for column in [*on, "spare"]]
    return sent.join(complete, same).drop(*helpers, "_many_present")
