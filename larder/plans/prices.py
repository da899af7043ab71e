"""Recipe and SKU prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import any_of, first_match, ratio
from larder.operators import calendar_now, label_days, range_average
from larder.plans import fixed_values as fixed
from larder.sources import WEEK


def recipe_price_by_segment(
    prices: DataFrame, first_week: str | None = None, last_week: str | None = None
) -> DataFrame:
    """Mean recipe price by segment, recipe and size over a range of weeks."""
    segment, center = F.col("segment"), F.col("distribution_center")
    kept = prices.filter(
        segment.isin(*fixed.RECIPE_PRICE_ANY_CENTER)
        | any_of((segment == s) & (center == c) for s, c in fixed.RECIPE_PRICE_CENTERS.items())
    )
    named = kept.withColumn(
        "segment",
        first_match([(segment == "GR", "GB"), (segment == "SE", "DKSE"), (segment == "NL", "BNL")], segment),
    )
    return range_average(
        named,
        label=WEEK,
        first=first_week or fixed.RECIPE_PRICE_WEEKS[0],
        last=last_week or fixed.RECIPE_PRICE_WEEKS[1],
        keys=["segment", "recipe_id", "size"],
        value=F.col("price"),
        out="cost",
    )


READINGS = ("shared", "france")
WEIGHTS = [(reading, period) for reading in READINGS for period in ("current", "next")]


def sku_prices(
    prices: DataFrame, skus: DataFrame, calendar: DataFrame, as_of: str | None = None
) -> DataFrame:
    """Mean price of each SKU in the current and in the next quarter.

    One row per ``scope``, market, code, currency and pair of means. Scope
    ``market`` holds two readings of each price, which may differ, in which case
    both rows stay:

    * ``shared``: the joint Benelux-France market is ``benelux``, and some
      markets and centers count in every quarter;
    * ``france``: the joint market is ``fr``, and only it counts in every quarter.

    Scope ``no`` holds the Norwegian center of the Danish-Swedish market, strictly
    by quarter. The next quarter's mean does not depend on the currency. All of
    this is summed in one pass, with a weight per reading and quarter that says
    how many calendar days a price counts for.
    """
    quarter = "running_quarter"
    now = calendar_now(calendar, "date_string_backwards", quarter, as_of)
    following = calendar_now(calendar, "date_string_backwards", quarter, as_of, offset=1)
    days = label_days(
        calendar,
        WEEK,
        {
            "current_days": F.col(quarter) == now.scalar(),
            "next_days": F.col(quarter) == following.scalar(),
        },
        total="all_days",
    )
    priced = (
        prices.join(
            skus.select(F.col("id").alias("culinary_sku_id"), "code", "market"),
            "culinary_sku_id",
            "left",
        )
        .join(days, WEEK, "left")
        .na.fill({"all_days": 1, "current_days": 0, "next_days": 0})
        .select("code", "currency", "price", F.inline(_weighted_targets()))
        .filter(any_of(F.col(f"{reading}_{period}") > 0 for reading, period in WEIGHTS))
    )

    price = F.col("price")
    sums = [F.sum(f"{reading}_current").alias(f"{reading}_days") for reading in READINGS]
    for reading, period in WEIGHTS:
        weight = F.col(f"{reading}_{period}")
        sums += [
            F.sum(price * weight).alias(f"{reading}_{period}_sum"),
            F.sum(F.when(price.isNotNull(), weight)).alias(f"{reading}_{period}_count"),
        ]
    group = ["scope", "market", "code"]
    summed = priced.groupBy(*group, "currency").agg(*sums)

    # One row per currency is left, so this window's groups are tiny.
    currencies = Window.partitionBy(*group)
    known = F.col("market").isNotNull() & F.col("code").isNotNull()

    def mean(column, over=lambda total: total):
        return ratio(over(F.col(f"{column}_sum")), over(F.col(f"{column}_count")))

    following_means = {
        f"{reading}_next": F.when(
            known, mean(f"{reading}_next", lambda column: F.sum(column).over(currencies))
        )
        for reading in READINGS
    }
    pairs = F.array(
        *(
            F.when(
                F.col(f"{reading}_days") > 0,
                F.struct(
                    mean(f"{reading}_current").alias("current_quarter_avg_sku_price"),
                    F.col(f"{reading}_next").alias("next_quarter_avg_sku_price"),
                ),
            )
            for reading in READINGS
        )
    )
    return summed.withColumns(following_means).select(
        *group, "currency", F.inline(F.array_distinct(F.array_compact(pairs)))
    )


def _weighted_targets() -> Column:
    """Scopes and markets a price counts for, with its weight in each reading."""
    market, center = F.col("market"), F.col("distribution_center")
    joint = market == "beneluxfr"
    always = market.isin(*fixed.ALWAYS_PRICED_MARKETS) | any_of(
        (market == m) & (center == c) for m, c in fixed.ALWAYS_PRICED_CENTERS.items()
    )
    zero, all_days = F.lit(0), F.col("all_days")

    def target(scope, label, shared, france):
        weights = dict(zip(READINGS, (shared, france)))
        return F.struct(
            F.lit(scope).alias("scope"),
            label.alias("market"),
            *(
                weights[reading](F.col(f"{period}_days")).alias(f"{reading}_{period}")
                for reading, period in WEIGHTS
            ),
        )

    own = target(
        "market",
        F.when(joint, "benelux").otherwise(market),
        shared=lambda inside: F.when(always, all_days).otherwise(inside),
        france=lambda inside: F.when(joint, zero).otherwise(inside),
    )
    french = target(
        "market", F.lit("fr"), shared=lambda inside: zero, france=lambda inside: all_days
    )
    norwegian = target("no", F.lit("no"), shared=lambda inside: inside, france=lambda inside: zero)
    in_norway = (market == "dkse") & (center == fixed.NO_PRICE_CENTER)
    return F.array_compact(F.array(own, F.when(joint, french), F.when(in_norway, norwegian)))
