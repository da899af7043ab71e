"""Small input tables for the plans, built from a few values and defaults."""

from __future__ import annotations

import datetime as dt

from larder.sources import SOURCE_SCHEMAS

AS_OF = "2024-05-15"

DEFAULTS = {
    "recipe": {
        "market": "gb",
        "recipe_code": "RC1",
        "version": 1,
        "status": "Ready for menu planning",
        "title": "Dish",
        "is_default": 1,
        "primary_protein": "Beef",
        "main_protein": "Meat",
        "hands_on_time": "10",
        "hands_off_time": "5",
        "target_preferences": "Classic",
        "target_products": "classic-box",
        "recipe_type": "Standard",
        "created_at": dt.datetime(2024, 1, 1),
        "updated_at": dt.datetime(2024, 1, 2),
    },
    "picklist": {"market": "gb", "segment_name": "GR", "name": "sku", "size": 2, "pick_count": 1.0},
    "sku": {"market": "gb"},
    "sku_price": {
        "distribution_center": "GR",
        "delivery_week": "2024-W20",
        "currency": "GBP",
        "price": 4.0,
    },
    "menu": {
        "market": "gb",
        "region_code": "gb",
        "brand_name": "Main",
        "item_type": "meal",
        "status": "planned",
        "slot_number": 1,
        "delivery_week": "2024-W20",
        "id": "m",
    },
    "slot_preference": {
        "recipe_preference": "Family",
        "country": "GB",
        "slot": 1,
        "delivery_week": "2024-W20",
        "year_quarter": "2024-Q2",
    },
    "recipe_scores": {
        "country": "GB",
        "region": "GB",
        "mainrecipecode": "RC1",
        "uniquerecipecode": "RC1-1",
        "score": 4.0,
        "rating_count": 200,
        "score_wscm": 3.0,
        "rating_count_wscm": 100,
        "delivery_week": "2024-W10",
    },
}


def calendar_rows():
    """Two quarters of seven-day weeks counted from the first of January 2024."""
    for number in range(182):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=number)
        yield {
            "date_string_backwards": day.isoformat(),
            "delivery_week": f"2024-W{number // 7 + 1:02d}",
            "running_week": 100 + number // 7,
            "running_quarter": 40 + number // 91,
        }


def build(spark, role, *rows, **common):
    """A frame of the role's columns; what a row leaves out has its default."""
    schema = SOURCE_SCHEMAS[role]
    filled = [{**DEFAULTS.get(role, {}), **common, **row} for row in rows]
    unknown = {name for row in filled for name in row} - set(schema.fieldNames())
    assert not unknown, unknown
    return spark.createDataFrame([[r.get(n) for n in schema.fieldNames()] for r in filled], schema)


def market(spark, **roles):
    """All input tables; roles that are not given are empty."""
    tables = {"calendar": build(spark, "calendar", *calendar_rows())}
    return {role: build(spark, role, *roles.get(role, ())) for role in SOURCE_SCHEMAS} | (
        {} if "calendar" in roles else tables
    )
