"""The whole plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import explode_tags, stack, today
from larder.operators.shape import ranged
from larder.plans import fixed_values as fixed
from larder.plans.demand import demand_recipes, slot_preferences
from larder.plans.picklists import picklist_costs
from larder.plans.pool import pool_recipes
from larder.plans.preferences import DEMAND_RULES, POOL_RULES, TAG_COLUMNS, with_preferences
from larder.plans.prices import sku_prices
from larder.plans.recipes import is_ready, poolable_recipes, ready_recipes
from larder.plans.schema import TAG_COLUMN
from larder.plans.scores import recipe_nutrition, recipe_scores, recipe_usage
from larder.sources import WEEK, Tables, conform, stage


def recipe_pool(
    tables: Tables,
    as_of: str | None = None,
    week_column: str = WEEK,
    slot_years_after: str = fixed.SLOT_YEARS_AFTER,
    sort: bool = True,
) -> DataFrame:
    """Pool recipes and demanded menu slots, one row per preference tag.

    ``tables`` maps the roles of ``SOURCE_SCHEMAS`` to frames. ``as_of`` is the
    day ``yyyy-MM-dd`` that counts as today in all of the result; the session's
    day at the time of the call if omitted. ``week_column`` is the name of the
    week column in the tables and in the result. ``sort`` orders the result by
    country and recipe code; leave it out when writing to files.

    Ready recipes, prices by SKU, costed recipes and joined pool rows are staged,
    which runs four jobs; the result itself is lazy.
    """
    t = conform(tables, week_column)
    as_of = as_of or today(t["recipe"].sparkSession)
    ready = stage(ready_recipes(t["recipe"]), "ready")
    prices = sku_prices(t["sku_price"], t["sku"], t["calendar"], as_of)
    # Costs are looked up by code, so recipes without one need none.
    costs = picklist_costs(ready.dropna(subset=["unique_recipe_code"]), t["picklist"], t["sku"], prices, t["box_item"])
    pool = pool_recipes(
        poolable_recipes(ready),
        costs,
        recipe_usage(t["recipe_usage"]),
        recipe_nutrition(t["segment_nutrition"]),
        recipe_scores(t["recipe_scores"]),
    )
    demand = demand_recipes(
        t["menu"],
        t["recipe"],
        t["calendar"],
        slot_preferences(t["slot_preference"], slot_years_after),
        as_of,
    )
    both = stack([with_preferences(pool, POOL_RULES), with_preferences(demand, DEMAND_RULES)])
    ready_rows = both.filter(is_ready(F.lower("country"), F.col("status")))
    order, tie = ["country", "uniquerecipecode"], "_tie"
    if sort:
        dealt = ranged(ready_rows, order, tie)
        result = explode_tags(dealt, TAG_COLUMNS, TAG_COLUMN, order=[*order, tie]).drop(tie)
    else:
        result = explode_tags(ready_rows, TAG_COLUMNS, TAG_COLUMN)
    return result.withColumnRenamed(WEEK, week_column)
