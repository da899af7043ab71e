"""Columns and types that the plans read from each input table.

Tables may have more columns; they are not read. Weeks are texts ``YYYY-Www``,
so their alphabetical order is their order in time. Minutes are numbers held as
text and may be empty. The week column is called ``WEEK`` inside the plans;
``read_tables`` and ``recipe_pool`` take the name it has outside.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

WEEK = "delivery_week"


def schema_of(columns: str) -> StructType:
    """A schema from ``name type`` pairs; needs no running session."""
    schema = StructType()
    for column in columns.split(","):
        schema.add(*column.split())
    return schema


SOURCE_SCHEMAS: dict[str, StructType] = {
    # Customer scores: recipe code, country and region, week.
    "recipe_scores": schema_of(
        f"country string, region string, mainrecipecode string, uniquerecipecode string, "
        f"score double, rating_count long, score_wscm double, rating_count_wscm long, "
        f"{WEEK} string"
    ),
    # Last and next use: recipe code, market, region.
    "recipe_usage": schema_of(
        "market string, region_code string, recipe_code string, last_used string, "
        "next_used string, absolute_last_used string, is_newrecipe integer, "
        "is_newscheduled integer"
    ),
    # Nutrition: recipe, segment.
    "segment_nutrition": schema_of(
        "market string, segment string, country string, recipe_id string, energy double, "
        "carbs double"
    ),
    # Recipe prices: recipe, size, segment, distribution center, week.
    "recipe_price": schema_of(
        f"segment string, distribution_center string, recipe_id string, size integer, price double, "
        f"{WEEK} string"
    ),
    # One row per day.
    "calendar": schema_of(
        f"date_string_backwards string, {WEEK} string, running_week integer, running_quarter integer"
    ),
    # SKU prices: SKU, distribution center, week.
    "sku_price": schema_of(
        f"culinary_sku_id string, distribution_center string, {WEEK} string, currency string, "
        f"price double"
    ),
    # SKU master.
    "sku": schema_of("id string, code string, market string"),
    # Recipe master: recipe, market, version.
    "recipe": schema_of(
        "id string, market string, unique_recipe_code string, recipe_code string, version integer, "
        "status string, title string, is_default integer, primary_protein string, "
        "main_protein string, protein_cut string, primary_starch string, main_starch string, "
        "primary_vegetable string, main_vegetable string, cuisine string, dish_type string, "
        "hands_on_time string, hands_on_time_max string, hands_off_time string, "
        "hands_off_time_max string, difficulty string, tags string, target_preferences string, "
        "target_products string, recipe_type string, created_at timestamp, updated_at timestamp"
    ),
    # Bill of materials: recipe, segment, size, SKU.
    "picklist": schema_of(
        "recipe_id string, market string, segment_name string, code string, name string, "
        "size integer, pick_count double"
    ),
    # Items per box, by SKU code.
    "box_item": schema_of("code string, boxitem double"),
    # Menus: market, week, slot.
    "menu": schema_of(
        f"market string, region_code string, brand_name string, item_type string, "
        f"status string, slot_number integer, {WEEK} string, id string, recipe_id string, "
        f"unique_recipe_code string"
    ),
    # Preference of each menu slot, by country and week.
    "slot_preference": schema_of(
        f"recipe_preference string, country string, slot integer, {WEEK} string, year_quarter string"
    ),
}
