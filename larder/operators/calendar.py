"""Period arithmetic on a day-grain calendar."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import all_of, ratio


def today(spark: SparkSession) -> str:
    """The session's day, ``yyyy-MM-dd``, taken once."""
    return spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd")).first()[0]


def calendar_now(
    calendar: DataFrame, day: str, period: str, as_of: str | None = None, offset: int = 0
) -> DataFrame:
    """One row, one column: the period of one day, moved by ``offset`` periods.

    ``as_of`` is a day written as in the ``day`` column, today (``yyyy-MM-dd``)
    when omitted. A day the calendar lacks gives NULL. Call ``.scalar()`` on the
    result to use it in another frame's expression.
    """
    as_of = today(calendar.sparkSession) if as_of is None else as_of
    on_day = calendar.filter(F.col(day) == F.lit(as_of))
    return on_day.agg((F.max(period) + F.lit(offset)).alias(period))


def label_days(
    calendar: DataFrame, label: str, inside: Mapping[str, Column], total: str = "days"
) -> DataFrame:
    """One row per label: its number of days, and how many satisfy each condition.

    Joining this instead of the day-grain calendar gives one row per fact rather
    than one per day, with the day count as a weight.
    """
    flagged = calendar.select(
        label, *(F.when(condition, 1).otherwise(0).alias(name) for name, condition in inside.items())
    )
    return flagged.groupBy(label).agg(
        F.count(F.lit(1)).cast("int").alias(total),
        *(F.sum(name).cast("int").alias(name) for name in inside),
    )


def day_weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of ``value`` as if each row occurred ``weight`` times; NULLs do not count."""
    return ratio(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def period_average(
    facts: DataFrame,
    calendar: DataFrame,
    *,
    label: str,
    period: str,
    now: DataFrame,
    keys: Sequence[str],
    value: Column,
    out: str,
    always: Column | None = None,
) -> DataFrame:
    """Mean of ``value`` per key over the facts of one period.

    Facts carry a ``label`` (a week, a month); the calendar has a row per day
    with its label and period, and a fact counts once for each of its label's
    days. ``now`` is the one-row frame of ``calendar_now``. Facts for which
    ``always`` holds count whatever their period, even with an unknown label.
    """
    days = label_days(calendar, label, {"_days_inside": F.col(period) == now.scalar()}, "_days")
    if always is None:
        weighted = facts.join(days.filter("_days_inside > 0"), label, "inner")
        weight = F.col("_days_inside")
    else:
        weighted = facts.join(days, label, "left")
        weight = F.when(always, F.coalesce("_days", F.lit(1))).otherwise(F.col("_days_inside"))
    return (
        weighted.withColumn("_weight", weight)
        .filter("_weight > 0")
        .groupBy(*keys)
        .agg(day_weighted_mean(value, F.col("_weight")).alias(out))
    )


def range_average(
    facts: DataFrame,
    *,
    label: str,
    first: str,
    last: str,
    keys: Sequence[str],
    value: Column,
    out: str,
) -> DataFrame:
    """Mean of ``value`` per key over labels between two labels, both included."""
    inside = facts.filter(F.col(label).between(first, last))
    return inside.groupBy(*keys).agg(day_weighted_mean(value, F.lit(1)).alias(out))


def period_compare(
    facts: DataFrame,
    calendar: DataFrame,
    *,
    label: str,
    period: str,
    now: DataFrame,
    following: DataFrame,
    keys: Sequence[str],
    value: Column,
    current_out: str,
    following_out: str,
) -> DataFrame:
    """Mean of ``value`` per key over one period, beside its mean over another.

    A key without facts in the period ``now`` has no row; one without facts in
    ``following``, or with a NULL in the key, has NULL there. As in
    ``period_average`` a fact counts once for each of its label's days. The facts
    are read once, with a weight per period.
    """
    inside = {"_now": F.col(period) == now.scalar(), "_following": F.col(period) == following.scalar()}
    days = label_days(calendar, label, inside, "_days").filter("_now + _following > 0")
    known = all_of(F.col(key).isNotNull() for key in keys)
    means = facts.join(days, label).groupBy(*keys).agg(
        F.sum("_now").alias("_now"),
        day_weighted_mean(value, F.col("_now")).alias(current_out),
        day_weighted_mean(value, F.col("_following")).alias("_next"),
    )
    return means.filter("_now > 0").select(*keys, current_out, F.when(known, F.col("_next")).alias(following_out))


def recent_window(
    df: DataFrame,
    calendar: DataFrame,
    *,
    label: str,
    period: str,
    since: DataFrame,
    columns: Sequence[str],
) -> DataFrame:
    """Distinct ``columns`` of the rows whose label reaches into ``since`` or later.

    ``since`` is a one-row frame of ``calendar_now``; there is no upper bound.
    """
    labels = calendar.filter(F.col(period) >= since.scalar()).select(label).distinct()
    return df.join(labels, label, "left_semi").select(*columns).distinct()
