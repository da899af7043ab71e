"""Per-recipe scores, usage and nutrition, by market."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import any_of, first_match, ratio
from larder.operators import remap_codes, rule_filter
from larder.plans import fixed_values as fixed
from larder.sources import WEEK


def recipe_scores(scores: DataFrame) -> DataFrame:
    """Rating-weighted mean scores of a recipe's latest week, by country.

    A score row can be ranked twice: by recipe and country under the limits of
    ``SCORE_RULES``, and, in GB, by recipe, region and code suffix. The rows are
    summed per ranking group and week before the latest week is picked. What is
    ranked then has one row per week and country, however many score rows a
    recipe has.
    """
    country, region = F.col("country"), F.col("region")
    scored = F.col("score") > 0
    by_country = scored & any_of(
        F.col(column).isin(*values) & (F.col("rating_count") > ratings)
        for column, values, ratings in fixed.SCORE_RULES
    )
    by_suffix = scored & (region == "GB") & (F.col("rating_count") > fixed.GB_SCORE_RATINGS)
    market = first_match(
        [
            (region.isin("DK", "SE"), "DKSE"),
            (region == "NO", "NO"),
            (country.isin("BE", "NL", "LU"), "BNL"),
        ],
        country,
    )
    suffix = F.right("uniquerecipecode", F.lit(2))
    suffix_class = F.when(suffix.isin(*fixed.GB_SEPARATE_SUFFIXES), suffix).otherwise("X")
    rankings = F.array_compact(
        F.array(
            F.when(
                by_country,
                F.struct(
                    F.lit("country").alias("ranking"),
                    country.alias("area"),
                    F.lit(None).cast("string").alias("suffix"),
                    market.alias("market"),
                ),
            ),
            F.when(
                by_suffix,
                F.struct(
                    F.lit("suffix").alias("ranking"),
                    region.alias("area"),
                    suffix_class.alias("suffix"),
                    country.alias("market"),
                ),
            ),
        )
    )
    group = ["ranking", "area", "suffix", "mainrecipecode"]
    weekly = (
        scores.filter(by_country | by_suffix)
        .select("*", F.inline(rankings))
        .groupBy(*group, "market", WEEK)
        .agg(
            F.sum(F.col("score") * F.col("rating_count")).alias("points"),
            F.sum("rating_count").alias("ratings"),
            F.sum(F.col("score_wscm") * F.col("rating_count_wscm")).alias("points_scm"),
            F.sum("rating_count_wscm").alias("ratings_scm"),
        )
    )
    newest_first = Window.partitionBy(*group).orderBy(F.desc(WEEK))
    return (
        weekly.withColumn("age", F.dense_rank().over(newest_first))
        .filter("age = 1")
        .groupBy(F.col("market").alias("country"), "mainrecipecode")
        .agg(
            ratio(F.sum("points"), F.sum("ratings")).alias("scorewoscm"),
            ratio(F.sum("points_scm"), F.sum("ratings_scm")).alias("scorescm"),
        )
    )


def recipe_usage(usage: DataFrame) -> DataFrame:
    """Usage rows that count, with the market they count for."""
    market, region = F.col("market"), F.col("region_code")
    kept = rule_filter(
        usage,
        [
            [market.isin(*fixed.USAGE_MARKETS), region.isNotNull()],
            [market == "gb"],
            [region != "dk"],
        ],
    )
    norway = (market == "dkse") & (region == "no")
    return remap_codes(kept, "country_final_id", [(norway, "no")], market)


def recipe_nutrition(nutrition: DataFrame) -> DataFrame:
    """Nutrition rows that count, with the market they count for."""
    market, segment, country = F.col("market"), F.col("segment"), F.col("country")
    kept = rule_filter(
        nutrition,
        [
            [~segment.isin("DK", "JP"), country != "ES"],
            [country == "GB", market == "gb"],
        ],
    )
    norway = (market == "dkse") & (segment == "NO")
    return remap_codes(kept, "country_final_id", [(norway, "no")], market)
