"""The recipe pool: its stages, and the whole."""

from larder.plans.demand import demand_recipes, menu_window, slot_preferences
from larder.plans.picklists import picklist_costs
from larder.plans.pool import pool_recipes
from larder.plans.prices import recipe_price_by_segment, sku_prices
from larder.plans.recipe_pool import recipe_pool
from larder.plans.recipes import poolable_recipes, ready_recipes
from larder.plans.scores import recipe_nutrition, recipe_scores, recipe_usage

__all__ = [
    "demand_recipes",
    "menu_window",
    "picklist_costs",
    "pool_recipes",
    "poolable_recipes",
    "ready_recipes",
    "recipe_nutrition",
    "recipe_pool",
    "recipe_price_by_segment",
    "recipe_scores",
    "recipe_usage",
    "sku_prices",
    "slot_preferences",
]
