"""Latest rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import all_of


def latest_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: str | Column
) -> DataFrame:
    """Keep, per key, every row that ties for the greatest ``order`` value.

    Keys and ``order`` may be column names or expressions. NULL is a key of its
    own and sorts below every other order value, so a key whose order values
    are all NULL keeps all of its rows.

    The greatest value per key is found by an aggregate that combines on the
    map side and reads only the key and order columns; the rows are then
    matched against it. No task ever holds or sorts a whole key group, so a key
    with a large share of the rows, or with any number of tied rows, is spread
    over tasks: the match is a broadcast when the per-key table is measured to
    be small, otherwise a sort-merge join whose oversized partitions adaptive
    execution splits.
    """
    as_col = lambda c: c if isinstance(c, Column) else F.col(c)
    row_names = [f"_row_key_{i}" for i in range(len(keys))]
    top_names = [f"_top_key_{i}" for i in range(len(keys))]
    rows = df.withColumns(
        {name: as_col(key) for name, key in zip(row_names, keys)} | {"_row_order": as_col(order)}
    )
    tops = rows.groupBy(*(F.col(r).alias(t) for r, t in zip(row_names, top_names))).agg(
        F.max("_row_order").alias("_top_order")
    )
    same = all_of(
        F.col(r).eqNullSafe(F.col(t))
        for r, t in [*zip(row_names, top_names), ("_row_order", "_top_order")]
    )
    return rows.join(tops, same, "inner").select(*df.columns)
