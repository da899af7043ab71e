"""Columns of the result."""

from __future__ import annotations

from larder.sources.schemas import WEEK, schema_of

# What is known about a recipe or a demanded menu slot.
BUSINESS_SCHEMA = schema_of(
    "recipe_id string, country string, uniquerecipecode string, code string, version integer, "
    "status string, title string, slot_number integer, menu_status string, lastused string, "
    "nextused string, absolutelastused string, isnewrecipe integer, isnewscheduled integer, "
    "isdefault integer, primaryprotein string, mainprotein string, proteincut string, "
    "primarystarch string, mainstarch string, primaryvegetable string, mainvegetable string, "
    "currency string, calories double, carbohydrates double, cuisine string, dishtype string, "
    "totaltime float, difficulty string, tag string, preference string, producttype string, "
    "recipetype string, created_at timestamp, updated_at timestamp, cost2p_current double, "
    "cost2p_next double, scorescm double, scorewoscm double, isscorereplace integer, "
    f"skucode string, skuname string, skucount long, source string, {WEEK} string"
)

# Names of the derived columns.
CHECK_COLUMN = "Category_Check"
LIST_COLUMN = "cross_preferences"
TAG_COLUMN = "Preferences"
