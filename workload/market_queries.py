"""The recipe pool and its stages over market tables.

Means of means depend on the order of summation in their last digits, so the
results that hold them are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import plans
from larder.sources import conform, new_path, read_tables, stage
from workload.market_sql import market_oracles
from workload.market_tables import AS_OF, RECIPE_PRICE_WEEKS, SLOT_YEARS_AFTER, market_tables
from workload.tables import configure

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark: SparkSession, sf_dir: str, *roles: str) -> list[DataFrame]:
    return list(conform(market_tables(configure(spark), sf_dir, *roles)).values())


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without time zone, as the driver's tables have them."""
    return df.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at") if c in df.columns}
    )


def market_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.recipe_scores(*_tables(spark, sf_dir, "recipe_scores"))


def market_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.recipe_usage(*_tables(spark, sf_dir, "recipe_usage"))


def market_nutrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.recipe_nutrition(*_tables(spark, sf_dir, "segment_nutrition"))


def market_usage_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table that is opened by its catalog name."""
    for role, df in market_tables(configure(spark), sf_dir, "recipe_usage").items():
        df.createOrReplaceTempView(f"my_{role}")
    tables = read_tables(spark, {"recipe_usage": "my_recipe_usage"})
    return plans.recipe_usage(conform(tables)["recipe_usage"])


def market_nutrition_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files, with a column that nothing reads."""
    path = new_path(configure(spark), "segment-nutrition")
    market_tables(spark, sf_dir, "segment_nutrition")["segment_nutrition"].withColumn("other", F.lit(1)).write.parquet(path)
    tables = read_tables(spark, {"segment_nutrition": path}, "parquet")
    return plans.recipe_nutrition(conform(tables)["segment_nutrition"])


def market_recipe_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    (prices,) = _tables(spark, sf_dir, "recipe_price")
    return plans.recipe_price_by_segment(prices, *RECIPE_PRICE_WEEKS)


def market_sku_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.sku_prices(*_tables(spark, sf_dir, "sku_price", "sku", "calendar"), AS_OF)


def market_ready_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(plans.ready_recipes(*_tables(spark, sf_dir, "recipe")))


def market_poolable_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.poolable_recipes(market_ready_recipes(spark, sf_dir))


def _costs(spark: SparkSession, sf_dir: str, ready: DataFrame) -> DataFrame:
    prices, skus, calendar, picklists, boxes = _tables(
        spark, sf_dir, "sku_price", "sku", "calendar", "picklist", "box_item"
    )
    priced = plans.sku_prices(prices, skus, calendar, AS_OF)
    return plans.picklist_costs(ready, picklists, skus, priced, boxes)


def market_picklist_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    (recipes,) = _tables(spark, sf_dir, "recipe")
    costs = _costs(spark, sf_dir, plans.ready_recipes(recipes))
    return _rounded(costs, 4, "cost2p_current", "cost2p_next")


def market_pool_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    recipes, usage, nutrition, scores = _tables(
        spark, sf_dir, "recipe", "recipe_usage", "segment_nutrition", "recipe_scores"
    )
    ready = stage(plans.ready_recipes(recipes), "ready")
    pool = plans.pool_recipes(
        plans.poolable_recipes(ready),
        _costs(spark, sf_dir, ready.dropna(subset=["unique_recipe_code"])),
        plans.recipe_usage(usage),
        plans.recipe_nutrition(nutrition),
        plans.recipe_scores(scores),
    )
    return _plain_times(_rounded(pool, 6, "scorescm", "scorewoscm"))


def market_menu_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.menu_window(*_tables(spark, sf_dir, "menu", "calendar"), AS_OF)


def market_slot_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.slot_preferences(*_tables(spark, sf_dir, "slot_preference"), SLOT_YEARS_AFTER)


def market_demand_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    menus, recipes, calendar, mapping = _tables(
        spark, sf_dir, "menu", "recipe", "calendar", "slot_preference"
    )
    slots = plans.slot_preferences(mapping, SLOT_YEARS_AFTER)
    return _plain_times(plans.demand_recipes(menus, recipes, calendar, slots, AS_OF))


def recipe_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = market_tables(configure(spark), sf_dir)
    pool = plans.recipe_pool(tables, AS_OF, slot_years_after=SLOT_YEARS_AFTER)
    return _plain_times(_rounded(pool, 6, "scorescm", "scorewoscm"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        market_scores,
        market_usage,
        market_nutrition,
        market_usage_by_name,
        market_nutrition_from_files,
        market_recipe_price,
        market_sku_prices,
        market_ready_recipes,
        market_poolable_recipes,
        market_picklist_costs,
        market_pool_recipes,
        market_menu_window,
        market_slot_preferences,
        market_demand_recipes,
        recipe_pool,
    )
}

ORACLES: dict[str, str] = market_oracles()
ORACLES["market_usage_by_name"] = ORACLES["market_usage"]
ORACLES["market_nutrition_from_files"] = ORACLES["market_nutrition"]
