"""The recipes planners may use, with everything known about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import matches
from larder.operators import (
    clean_columns,
    duration_total,
    enrich,
    fan_out_join,
    hierarchical_mean_fill,
    pad_to_schema,
    rule_filter,
    sentinel_fill,
)
from larder.plans import fixed_values as fixed
from larder.plans.schema import BUSINESS_SCHEMA
from larder.sources import release, stage


def pool_rules() -> list[list[Column]]:
    """Per group of markets, what a recipe and its cost must satisfy."""
    market, protein, title = F.col("market"), F.col("primary_protein"), F.lower("title")
    cost, code = F.col("cost2p_current"), F.col("unique_recipe_code")
    named = F.length(protein) > 0
    return [
        [market.isin(*fixed.PROTEIN_REQUIRED_MARKETS), named, protein != fixed.NO_PROTEIN, cost > 0],
        [market.isin(*fixed.COST_ONLY_MARKETS), cost > 0],
        [
            market == "gb",
            named,
            ~protein.isin(*fixed.GB_EXCLUDED_PROTEINS),
            cost > fixed.GB_MINIMUM_COST,
            *(~matches(title, pattern) for pattern in fixed.GB_EXCLUDED_TITLES),
            *(~matches(code, pattern) for pattern in fixed.GB_EXCLUDED_CODES),
            ~F.col("target_products").isin(*fixed.GB_EXCLUDED_PRODUCTS),
        ],
    ]


def _with_total_minutes(rows: DataFrame) -> DataFrame:
    """Hands-on plus hands-off time; some markets plan with the maximum times."""
    parts = {"_maximum": ["hands_on_time_max", "hands_off_time_max"], "_plain": ["hands_on_time", "hands_off_time"]}
    for out, columns in parts.items():
        rows = duration_total(rows, columns, out, fixed.MISSING_MINUTES)
    uses_maximum = F.col("market").isin(*fixed.MAXIMUM_MINUTES_MARKETS)
    total = F.when(uses_maximum, F.col("_maximum")).when(~uses_maximum, F.col("_plain"))
    return rows.withColumn("totaltime", total).drop(*parts)


USAGE_KEYS = ["recipe_code", "market"]
NUTRITION_KEYS = ["id", "market"]


def pool_recipes(
    poolable: DataFrame,
    costs: DataFrame,
    usage: DataFrame,
    nutrition: DataFrame,
    scores: DataFrame,
) -> DataFrame:
    """One row per pool recipe, cost currency, usage region and nutrition segment.

    Every rule asks for a positive cost, so recipes are first joined to their
    costs and filtered; only what is left is joined to the rest.

    Missing scores become the mean over the pool rows of the same protein, all
    markets together. How many pool rows a recipe will have follows from the
    number of its usage and nutrition rows, so the means are taken with those as
    weights, on staged recipes, before the rows themselves are joined on. The
    same numbers tell which recipes have no usage or nutrition.
    """
    usage = usage.select(
        "recipe_code",
        F.col("country_final_id").alias("market"),
        "last_used",
        "next_used",
        "absolute_last_used",
        "is_newrecipe",
        "is_newscheduled",
    )
    nutrition = nutrition.select(
        F.col("recipe_id").alias("id"),
        F.col("country_final_id").alias("market"),
        "energy",
        "carbs",
    )
    scores = scores.select(
        F.col("mainrecipecode").alias("recipe_code"),
        F.lower("country").alias("market"),
        "scorescm",
        "scorewoscm",
    )
    eligible = stage(rule_filter(poolable.join(costs, ["unique_recipe_code", "market"]), pool_rules()), "eligible")
    # What the costs have shuffled goes before scores, usage and nutrition are.
    release(eligible.sparkSession)
    counted = enrich(
        eligible,
        [
            (scores, USAGE_KEYS, "left"),
            (_row_counts(usage, USAGE_KEYS, "usage_rows"), USAGE_KEYS, "left"),
            (_row_counts(nutrition, NUTRITION_KEYS, "nutrition_rows"), NUTRITION_KEYS, "left"),
        ],
    )
    one = F.lit(1)
    pool_rows = F.coalesce("usage_rows", one) * F.coalesce("nutrition_rows", one)
    staged = stage(counted.withColumn("pool_rows", pool_rows), "pool")
    release(staged.sparkSession)
    scored = hierarchical_mean_fill(
        staged,
        {"scorescm": "scorescm", "scorewoscm": "scorewoscm"},
        ["primary_protein", "main_protein"],
        fixed.MISSING_SCORE,
        flags={"scorewoscm": "isscorereplace"},
        weight=F.col("pool_rows"),
    )
    rows = fan_out_join(scored, usage, USAGE_KEYS, F.col("usage_rows").isNotNull())
    rows = fan_out_join(rows, nutrition, NUTRITION_KEYS, F.col("nutrition_rows").isNotNull())
    return pad_to_schema(_named(rows), BUSINESS_SCHEMA, {"source": "Recipe Pool"})


def _row_counts(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def _named(rows: DataFrame) -> DataFrame:
    """Output names and the columns computed row by row."""
    cleaned = clean_columns(_with_total_minutes(rows), ["title"])
    for column in ("energy", "carbs"):
        cleaned = sentinel_fill(cleaned, column, fixed.MISSING_NUTRITION, [0])
    return cleaned.withColumnsRenamed(
        {
            "id": "recipe_id",
            "unique_recipe_code": "uniquerecipecode",
            "recipe_code": "code",
            "last_used": "lastused",
            "next_used": "nextused",
            "is_default": "isdefault",
            "primary_protein": "primaryprotein",
            "main_protein": "mainprotein",
            "protein_cut": "proteincut",
            "primary_starch": "primarystarch",
            "main_starch": "mainstarch",
            "main_vegetable": "mainvegetable",
            "dish_type": "dishtype",
            "tags": "tag",
            "target_preferences": "preference",
            "target_products": "producttype",
            "recipe_type": "recipetype",
            "energy": "calories",
            "carbs": "carbohydrates",
        }
    ).withColumns(
        {
            "country": F.upper("market"),
            "absolutelastused": F.coalesce("absolute_last_used", F.lit("")),
            "isnewrecipe": F.coalesce("is_newrecipe", F.lit(1)),
            "isnewscheduled": F.coalesce("is_newscheduled", F.lit(0)),
            "primaryvegetable": F.coalesce("primary_vegetable", F.lit("none")),
            "cost2p_current": F.round("cost2p_current", 2),
            "cost2p_next": F.round("cost2p_next", 2),
        }
    )
