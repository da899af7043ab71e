"""Means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import ratio


def weighted_mean(
    df: DataFrame,
    keys: Sequence[str],
    means: Mapping[str, tuple[Column, Column]],
) -> DataFrame:
    """Sum of value*weight over sum of weight, per key and output column.

    ``means`` maps an output name to its (value, weight). The divisor counts the
    weight of rows whose value is NULL too; a divisor of zero gives NULL.
    """
    return df.groupBy(*keys).agg(
        *(
            ratio(F.sum(value * weight), F.sum(weight)).alias(name)
            for name, (value, weight) in means.items()
        )
    )
