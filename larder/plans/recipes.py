"""The recipe master: what is ready, and what may enter the pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import any_of
from larder.operators import exclude_patterns, latest_per_key, replicate_segment
from larder.plans import fixed_values as fixed


def is_ready(market: Column, status: Column, markets=tuple(fixed.READY_STATUSES)) -> Column:
    """Whether a recipe's status is ready in its market."""
    return any_of(
        (market == m) & F.lower(status).isin(*fixed.READY_STATUSES[m]) for m in markets
    )


def with_norway(recipes: DataFrame) -> DataFrame:
    """Danish-Swedish recipes once more as recipes of the market ``no``."""
    return replicate_segment(recipes, F.col("market") == "dkse", {"market": "no"})


def ready_recipes(recipes: DataFrame) -> DataFrame:
    """Ready recipes: the newest version, or the default one, per market.

    Markets that use the default version keep all default rows; giving those no
    version makes them tie, so one pass serves both kinds of market.
    """
    market = F.col("market")
    uses_default = market.isin(*fixed.DEFAULT_VERSION_MARKETS)
    listed = [m for m in fixed.READY_STATUSES if m != "no"]
    ready = recipes.filter(
        is_ready(market, F.col("status"), listed)
        & (~(uses_default | (market == "gb")) | (F.col("is_default") == 1))
    )
    version = F.when(~uses_default, F.col("version"))
    return with_norway(latest_per_key(ready, ["recipe_code", "market"], version))


def poolable_recipes(ready: DataFrame) -> DataFrame:
    """Ready recipes without add-ons; an unknown product or type drops out too."""
    return exclude_patterns(
        ready,
        like={
            "target_products": fixed.EXCLUDED_PRODUCT_PATTERNS,
            "recipe_type": fixed.EXCLUDED_RECIPE_TYPE_PATTERNS,
        },
        values={"target_products": fixed.EXCLUDED_PRODUCTS},
    )
