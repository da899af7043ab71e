"""Recipes on recent menus, with the preference of their slot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import (
    calendar_now,
    exclude_patterns,
    latest_per_key,
    pad_to_schema,
    recent_window,
    remap_codes,
)
from larder.plans import fixed_values as fixed
from larder.plans.preferences import SLOT_RULES, with_preferences
from larder.plans.recipes import with_norway
from larder.plans.schema import BUSINESS_SCHEMA, LIST_COLUMN
from larder.sources import WEEK

MENU_COLUMNS = (
    "market",
    "region_code",
    "slot_number",
    WEEK,
    "menu_status",
    "id_menu",
    "recipe_id",
    "unique_recipe_code",
)


def menu_window(
    menus: DataFrame,
    calendar: DataFrame,
    as_of: str | None = None,
    columns: Sequence[str] = MENU_COLUMNS,
) -> DataFrame:
    """Distinct menu slots from twelve weeks ago onwards, by planning market."""
    market, region, slot = F.col("market"), F.col("region_code"), F.col("slot_number")
    offered = menus.filter(
        (F.col("item_type") != fixed.EXCLUDED_ITEM_TYPE)
        & (F.col("brand_name") != fixed.EXCLUDED_BRAND)
        & (region != fixed.EXCLUDED_REGION)
        & (F.col("status") != fixed.EXCLUDED_MENU_STATUS)
        & ~market.isin(*fixed.EXCLUDED_MARKETS)
    )
    second_brand_slot = ((slot > 50) & (slot < 1000)) | (slot > 4000)
    by_market = remap_codes(
        offered,
        "market",
        [((market == "ca") & second_brand_slot, "ck"), (region == "se", "dkse"), (region == "no", "no")],
        market,
    ).withColumnsRenamed({"status": "menu_status", "id": "id_menu"})
    since = calendar_now(
        calendar, "date_string_backwards", "running_week", as_of, offset=-fixed.DEMAND_WEEKS
    )
    return recent_window(
        by_market, calendar, label=WEEK, period="running_week", since=since, columns=columns
    )


def slot_preferences(
    mapping: DataFrame, years_after: str = fixed.SLOT_YEARS_AFTER
) -> DataFrame:
    """Preference lists of menu slots in each country's latest mapped week."""
    recent = mapping.filter(F.left("year_quarter", F.lit(4)) > years_after)
    latest = latest_per_key(recent, ["country"], WEEK).withColumnRenamed(
        "recipe_preference", "preference"
    )
    named = exclude_patterns(
        latest.filter(F.col("slot").isNotNull()),
        values={"preference": fixed.EXCLUDED_SLOT_PREFERENCES},
    )
    country = F.col("country")
    return (
        remap_codes(
            with_preferences(named, SLOT_RULES),
            "country",
            [(country == "DK", "dkse"), (country == "BE", "benelux")],
            F.lower(country),
        )
        .select("country", "slot", WEEK, "year_quarter", F.col(LIST_COLUMN).alias("preference_slot"))
        .distinct()
    )


def demand_recipes(
    menus: DataFrame,
    recipes: DataFrame,
    calendar: DataFrame,
    slots: DataFrame,
    as_of: str | None = None,
) -> DataFrame:
    """Recipes on recent menus in any version, one row per slot preference.

    A slot keeps its latest preference for all the weeks of the window. Slots
    without a recipe or a preference do not count. The market is taken from the
    recipe, so that a filter on market and status reaches the recipe scan.
    """
    offered = menu_window(
        menus,
        calendar,
        as_of,
        ["market", "slot_number", WEEK, "menu_status", "unique_recipe_code"],
    ).filter(~F.col("market").isin(*fixed.EXCLUDED_MARKETS))
    made = with_norway(recipes).select(
        F.col("id").alias("recipe_id"),
        F.col("market").alias("recipe_market"),
        F.col("unique_recipe_code").alias("uniquerecipecode"),
        F.col("recipe_code").alias("code"),
        "version",
        "status",
        "title",
        F.col("primary_protein").alias("primaryprotein"),
        F.col("main_protein").alias("mainprotein"),
        F.col("protein_cut").alias("proteincut"),
        F.col("primary_starch").alias("primarystarch"),
        F.col("main_starch").alias("mainstarch"),
        F.col("primary_vegetable").alias("primaryvegetable"),
        F.col("main_vegetable").alias("mainvegetable"),
        "cuisine",
        F.col("dish_type").alias("dishtype"),
        F.col("tags").alias("tag"),
        F.col("target_products").alias("producttype"),
        F.col("recipe_type").alias("recipetype"),
        "created_at",
        "updated_at",
    )
    preferred = slots.select(
        F.col("country").alias("slot_market"), "slot", F.col("preference_slot").alias("preference")
    ).distinct()
    rows = offered.join(
        made,
        (F.col("unique_recipe_code") == F.col("uniquerecipecode"))
        & (F.col("market") == F.col("recipe_market")),
    ).join(
        preferred,
        (F.col("slot_number") == F.col("slot")) & (F.col("market") == F.col("slot_market")),
    )
    return pad_to_schema(
        rows.withColumn("country", F.upper("recipe_market")), BUSINESS_SCHEMA, {"source": "Demand"}
    )
