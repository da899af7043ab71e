"""Recipe cost from picklists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import any_of, clean_text
from larder.operators import bom_rollup
from larder.plans import fixed_values as fixed
from larder.sources import release, stage

# A picklist row is priced along up to three routes. Results of different
# routes are stacked, never merged, even for the same recipe.
SHARED, FRANCE, NORWAY = "shared", "france", "norway"
ROUTE_KEYS = ["route", "market", "code"]


def _routed_lines(picklists: DataFrame) -> DataFrame:
    """Picklist rows by route, combined per recipe, SKU and name.

    Only the units for two persons are priced, except that Norway takes those
    for four persons for the next quarter. A route's zero flag says that a SKU
    also has rows of other sizes, which cost 0 rather than nothing.
    """
    market, segment = F.col("market"), F.col("segment_name")
    shared = market.isin(*fixed.PICKLIST_ANY_SEGMENT) | any_of(
        (market == m) & (segment == s) for m, s in fixed.PICKLIST_SEGMENTS.items()
    )
    france = (market == "fr") & (segment == fixed.PICKLIST_SEGMENTS["fr"])

    def route(condition, name, target, next_size):
        return F.when(
            condition,
            F.struct(
                F.lit(name).alias("route"),
                target.alias("route_market"),
                F.lit(next_size).alias("next_size"),
            ),
        )

    routes = F.array_compact(
        F.array(
            route(shared, SHARED, market, 2),
            route(france, FRANCE, market, 2),
            route(segment == "NO", NORWAY, F.lit("no"), 4),
        )
    )
    size, units = F.col("size"), F.col("pick_count")

    def units_of(persons):
        return F.sum(F.when(size == persons, units))

    def other_sizes(persons):
        return F.bool_or(F.coalesce(size != persons, F.lit(True)))

    return (
        picklists.select("*", F.inline(routes))
        .groupBy(
            "route",
            F.col("route_market").alias("market"),
            F.col("recipe_id").alias("id"),
            "code",
            clean_text(F.col("name")).alias("name"),
        )
        .agg(
            units_of(2).alias("current_units"),
            other_sizes(2).alias("current_zero"),
            units_of(F.col("next_size")).alias("next_units"),
            other_sizes(F.col("next_size")).alias("next_zero"),
        )
    )


def _routed_skus(skus: DataFrame, sku_prices: DataFrame) -> DataFrame:
    """Prices by route, market and code, and how often the master lists the SKU."""
    market = F.col("market")
    joint = market == "beneluxfr"
    targets = F.array_compact(
        F.array(
            F.struct(
                F.lit(SHARED).alias("route"),
                F.when(joint, "benelux").otherwise(market).alias("route_market"),
            ),
            F.when(
                joint | (market == "fr"),
                F.struct(F.lit(FRANCE).alias("route"), F.lit("fr").alias("route_market")),
            ),
        )
    )
    listed = (
        skus.select("code", F.inline(targets))
        .groupBy("route", F.col("route_market").alias("market"), "code")
        .agg(F.count(F.lit(1)).alias("listings"))
        .withColumn("scope", F.lit("market"))
    )
    # Listed SKUs may lack a price. Prices of unlisted SKUs count in Norway only.
    # Both sides hold few rows per key, whatever the size of the tables.
    either = listed.join(sku_prices, ["scope", "market", "code"], "full")
    route = F.coalesce("route", F.when(F.col("scope") == "no", NORWAY))
    return (
        either.withColumns({"route": route, "listings": F.coalesce("listings", F.lit(1))})
        .filter(F.col("route").isNotNull())
        .drop("scope")
    )


def picklist_costs(
    ready: DataFrame,
    picklists: DataFrame,
    skus: DataFrame,
    sku_prices: DataFrame,
    box_items: DataFrame,
) -> DataFrame:
    """SKU lists and cost for two persons per recipe code, market and currency.

    A SKU that the master lists several times counts that often, and so does one
    with several box-item rows; prices in both readings of ``sku_prices`` add up.
    """
    boxes = (
        box_items.groupBy("code", "boxitem")
        .agg(F.count(F.lit(1)).alias("box_rows"))
        .withColumn("route", F.lit(NORWAY))
    )
    norway = F.col("route") == NORWAY
    # A row or few for each SKU, from all prices: what those have shuffled goes before picklists are shuffled.
    routed_skus = stage(_routed_skus(skus, sku_prices), "routed-skus")
    release(routed_skus.sparkSession)
    lines = (
        _routed_lines(picklists)
        .join(ready.select("id", "market", "unique_recipe_code"), ["id", "market"])
        .join(routed_skus, ROUTE_KEYS, "left")
        .filter(norway | F.col("listings").isNotNull())
        .join(boxes, ["route", "code"], "left")
        .na.fill({"listings": 1, "box_rows": 1})
    )

    def cost(units, price, zero):
        priced = F.coalesce(F.col(units) * F.col(price), F.when(F.col(zero), F.lit(0.0)))
        return priced * F.col("listings") * F.col("box_rows")

    costs = bom_rollup(
        lines,
        parents=["route", "unique_recipe_code", "market", "currency"],
        item="code",
        name="name",
        price="current_quarter_avg_sku_price",
        costs={
            "cost2p_current": cost("current_units", "current_quarter_avg_sku_price", "current_zero"),
            "cost2p_next": cost("next_units", "next_quarter_avg_sku_price", "next_zero"),
        },
        item_attributes={"boxitem": F.when(norway, F.coalesce("boxitem", F.lit(0.0)))},
        items_out="skucode",
        names_out="skuname",
        count_out="skucount",
        missing_out="pricemissingskus",
    )
    return costs.drop("route")
