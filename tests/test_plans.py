"""Meaning of the plans, on small tables with results worked out by hand."""

from __future__ import annotations

import importlib

import pytest
from conftest import rows
from market_fixture import AS_OF, build, calendar_rows, market
from pyspark.sql import functions as F

from larder import plans
from larder.plans.preferences import DEMAND_RULES, POOL_RULES, SLOT_RULES, TAG_COLUMNS, with_preferences


@pytest.fixture(scope="session")
def make(spark):
    return lambda role, *data, **common: build(spark, role, *data, **common)


@pytest.fixture(scope="session")
def calendar(spark):
    return build(spark, "calendar", *calendar_rows()).cache()


# --- scores, usage, nutrition ---


def test_scores_use_all_rows_of_the_latest_week(make):
    out = plans.recipe_scores(
        make(
            "recipe_scores",
            {"score": 1.0},
            {"score": 2.0, "rating_count": 300, "delivery_week": "2024-W11", "rating_count_wscm": 0},
            {"score": 4.0, "rating_count": 100 + 1, "delivery_week": "2024-W11", "score_wscm": None},
            {"score": 5.0, "rating_count": 100, "delivery_week": "2024-W12"},
            {"score": 3.0, "uniquerecipecode": "RC1-FR", "rating_count": 401},
        )
    )
    (row,) = out.collect()
    assert row.country == "GB"
    assert row.scorewoscm == pytest.approx((2 * 300 + 4 * 101 + 3 * 401) / (300 + 101 + 401))
    assert row.scorescm == pytest.approx((0 + 3 * 100) / (0 + 100 + 100))


def test_scores_rank_by_source_country_and_report_the_market(make):
    out = plans.recipe_scores(
        make(
            "recipe_scores",
            {"country": "SE", "region": "SE", "score": 2.0, "rating_count": 51, "delivery_week": "2024-W01"},
            {"country": "DK", "region": "DK", "score": 4.0, "rating_count": 51, "delivery_week": "2024-W09"},
            {"country": "DK", "region": "DK", "score": 1.0, "rating_count": 50, "delivery_week": "2024-W10"},
            {"country": "NL", "region": "BNLF", "rating_count": 1, "rating_count_wscm": 0},
            {"country": "NO", "region": "NO", "rating_count": 10},
            {"country": "IT", "region": "IT", "score": 0.0},
            {"country": "IE", "region": "IE", "rating_count": 1},
        )
    )
    assert rows(out.select("country", "scorewoscm", "scorescm")) == [
        ("BNL", 4.0, None),
        ("DKSE", 3.0, 3.0),
        ("IE", 4.0, 3.0),
    ]


def test_usage_admits_all_but_danish_and_unknown_regions(make):
    kept = plans.recipe_usage(
        make(
            "recipe_usage",
            *(
                {"market": m, "region_code": r}
                for m, r in [
                    ("dkse", "se"), ("dkse", "no"), ("dkse", "dk"), ("dkse", None),
                    ("gb", None), ("it", None), ("it", "dk"), ("us", "x"), ("gb", "dk"),
                ]
            ),
        )
    )
    assert rows(kept.select("market", "region_code", "country_final_id")) == [
        ("dkse", "no", "no"), ("dkse", "se", "dkse"), ("gb", "dk", "gb"), ("gb", None, "gb"),
        ("it", "dk", "it"), ("us", "x", "us"),
    ]


def test_nutrition_readmits_british_rows(make):
    kept = plans.recipe_nutrition(
        make(
            "segment_nutrition",
            *(
                {"market": m, "segment": s, "country": c}
                for m, s, c in [
                    ("dkse", "SE", "SE"), ("dkse", "NO", "NO"), ("dkse", "DK", "DK"),
                    ("gb", "DK", "GB"), ("us", "DK", "GB"), ("es", "ES", "ES"), ("it", "IT", None),
                ]
            ),
        )
    )
    assert rows(kept.select("market", "segment", "country_final_id")) == [
        ("dkse", "NO", "no"), ("dkse", "SE", "dkse"), ("gb", "DK", "gb"),
    ]


# --- prices ---


def _prices(make, calendar, skus, prices):
    out = plans.sku_prices(make("sku_price", *prices), make("sku", *skus), calendar, AS_OF)
    return rows(out)


def test_prices_by_quarter_and_always_priced_centers(make, calendar):
    skus = [{"id": "1", "code": "A", "market": "gb"}]
    prices = [
        {"culinary_sku_id": "1", "price": 2.0, "distribution_center": "XX"},
        {"culinary_sku_id": "1", "price": 8.0, "delivery_week": "2024-W02", "distribution_center": "XX"},
        {"culinary_sku_id": "1", "price": 5.0, "delivery_week": "2024-W02"},
    ]
    # The center GR counts in every quarter under the shared reading only.
    assert _prices(make, calendar, skus, prices) == [
        ("market", "gb", "A", "GBP", 2.0, None),
        ("market", "gb", "A", "GBP", 3.5, 5.0),
    ]


def test_joint_market_is_priced_as_two(make, calendar):
    skus = [{"id": "1", "code": "A", "market": "beneluxfr"}]
    prices = [
        {"culinary_sku_id": "1", "price": 2.0, "currency": "EUR"},
        {"culinary_sku_id": "1", "price": 6.0, "currency": "EUR", "delivery_week": "9999-W99"},
    ]
    # Seven days of the known week against one row of the unknown one.
    mean = (7 * 2.0 + 6.0) / 8
    assert _prices(make, calendar, skus, prices) == [
        ("market", "benelux", "A", "EUR", mean, mean),
        ("market", "fr", "A", "EUR", mean, mean),
    ]


def test_norway_is_strict_and_next_ignores_currency(make, calendar):
    skus = [{"id": "1", "code": "A", "market": "dkse"}]
    next_week = "2024-W27"
    extra = [{"date_string_backwards": "2024-07-01", "delivery_week": next_week, "running_week": 126, "running_quarter": 42}]
    longer = calendar.unionByName(make("calendar", *extra))
    prices = [
        {"culinary_sku_id": "1", "distribution_center": "MO", "currency": "NOK", "price": 2.0},
        {"culinary_sku_id": "1", "distribution_center": "MO", "currency": "SEK", "price": 3.0},
        {"culinary_sku_id": "1", "distribution_center": "MO", "currency": "NOK", "price": 4.0, "delivery_week": next_week},
        {"culinary_sku_id": "1", "distribution_center": "MO", "currency": "DKK", "price": 6.0, "delivery_week": next_week},
        {"culinary_sku_id": "1", "distribution_center": "MO", "currency": "NOK", "price": 99.0, "delivery_week": "2024-W01"},
    ]
    out = _prices(make, longer, skus, prices)
    assert [r for r in out if r[0] == "no"] == [
        ("no", "no", "A", "NOK", 2.0, 5.0), ("no", "no", "A", "SEK", 3.0, 5.0),
    ]


def test_unlisted_skus_have_no_next_price(make, calendar):
    out = _prices(make, calendar, [], [{"culinary_sku_id": "9", "price": 2.0}])
    assert out == [("market", None, None, "GBP", 2.0, None)]


def test_a_day_outside_the_calendar_leaves_the_scopes(make, calendar):
    skus = [{"id": "1", "code": "A", "market": "it"}, {"id": "2", "code": "B", "market": "us"}]
    prices = [{"culinary_sku_id": "1"}, {"culinary_sku_id": "2"}]
    out = plans.sku_prices(make("sku_price", *prices), make("sku", *skus), calendar, "1999-01-01")
    assert rows(out) == [("market", "it", "A", "GBP", 4.0, 4.0)]


def test_recipe_price_by_segment(make):
    out = plans.recipe_price_by_segment(
        make(
            "recipe_price",
            *(
                {"segment": s, "distribution_center": c, "recipe_id": "r", "size": 2, "price": p, "delivery_week": w}
                for s, c, p, w in [
                    ("GR", "GR", 1.0, "2023-W30"), ("GR", "GR", 3.0, "2023-W43"),
                    ("GR", "XX", 9.0, "2023-W31"), ("GR", "GR", 9.0, "2023-W44"),
                    ("NL", "DH", 5.0, "2023-W31"), ("BE", "DH", 5.0, "2023-W31"),
                    ("IT", None, 6.0, "2023-W31"), ("SE", "SK", 7.0, "2023-W31"),
                ]
            ),
        )
    )
    assert rows(out) == [("BNL", "r", 2, 5.0), ("DKSE", "r", 2, 7.0), ("GB", "r", 2, 2.0), ("IT", "r", 2, 6.0)]


# --- recipes ---


def test_ready_recipes(make):
    out = plans.ready_recipes(
        make(
            "recipe",
            {"id": "gb-old", "version": 1},
            {"id": "gb-a", "version": 2},
            {"id": "gb-b", "version": 2},
            {"id": "gb-not-default", "version": 3, "is_default": 0},
            {"id": "gb-planned", "version": 9, "status": "planned"},
            {"id": "it-old", "market": "it", "version": 1, "status": "IN DEVELOPMENT"},
            {"id": "it-new", "market": "it", "version": 2, "is_default": 0},
            {"id": "dk", "market": "dkse", "is_default": None},
            {"id": "fr", "market": "fr", "status": "Planned"},
            {"id": "es", "market": "es"},
            {"id": "no", "market": "no"},
        )
    )
    assert rows(out.select("id", "market")) == [
        ("dk", "dkse"), ("dk", "no"), ("fr", "fr"), ("gb-a", "gb"), ("gb-b", "gb"), ("it-old", "it"),
    ]


def test_poolable_recipes_need_a_known_product_and_type(make):
    out = plans.poolable_recipes(
        make(
            "recipe",
            {"id": "ok"},
            {"id": "ok2", "target_products": "Modularity", "recipe_type": "Addon"},
            {"id": "1", "target_products": None},
            {"id": "2", "recipe_type": None},
            {"id": "3", "target_products": "x gc-y"},
            {"id": "4", "target_products": "1.2-nl-only"},
            {"id": "5", "recipe_type": "Add-On x"},
            {"id": "6", "target_products": "add-ons"},
        )
    )
    assert rows(out.select("id")) == [("ok",), ("ok2",)]


# --- picklists ---


def _costs(make, recipes, picklist, skus, prices, boxes=()):
    schema = (
        "scope string, market string, code string, currency string, "
        "current_quarter_avg_sku_price double, next_quarter_avg_sku_price double"
    )
    spark = make("sku").sparkSession
    out = plans.picklist_costs(
        make("recipe", *recipes),
        make("picklist", *picklist),
        make("sku", *skus),
        spark.createDataFrame(list(prices), schema),
        make("box_item", *boxes),
    )
    columns = ["market", "currency", "skucode", "boxitem", "skucount", "cost2p_current", "cost2p_next", "pricemissingskus"]
    return rows(out.select(*columns))


def test_costs_count_sizes_listings_and_both_readings(make):
    out = _costs(
        make,
        [{"id": "r", "unique_recipe_code": "U"}],
        [
            {"recipe_id": "r", "code": "A", "pick_count": 3.0, "name": "a\tx"},
            {"recipe_id": "r", "code": "A", "pick_count": 5.0, "name": "ax\n", "size": 4},
            {"recipe_id": "r", "code": "B", "pick_count": 2.0},
            {"recipe_id": "r", "code": "B", "pick_count": 2.0, "segment_name": "XX"},
            {"recipe_id": "r", "code": "unlisted", "pick_count": 2.0},
        ],
        [{"id": "1", "code": "A"}, {"id": "2", "code": "A"}, {"id": "3", "code": "B"}],
        [
            ("market", "gb", "A", "GBP", 10.0, None),
            ("market", "gb", "B", "GBP", 1.0, 7.0),
            ("market", "gb", "B", "GBP", 2.0, None),
            ("no", "gb", "A", "GBP", 1000.0, 1000.0),
        ],
    )
    # A is listed twice; B has two prices; A's other size keeps its next cost at 0.
    assert out == [("gb", "GBP", "A | B", None, 2, 2 * 30.0 + 2 * 1 + 2 * 2, 14.0, "")]


def test_unpriced_items_form_a_row_without_currency(make):
    out = _costs(
        make,
        [{"id": "r", "unique_recipe_code": "U"}],
        [{"recipe_id": "r", "code": "A"}, {"recipe_id": "r", "code": "B"}, {"recipe_id": "r", "code": "C"}],
        [{"id": "1", "code": "A"}, {"id": "2", "code": "B"}, {"id": "3", "code": "C"}],
        [("market", "gb", "A", "GBP", 4.0, 4.0), ("market", "gb", "C", "GBP", 0.0, 4.0)],
    )
    assert out == [
        ("gb", "GBP", "A | C", None, 2, 4.0, 8.0, "C"),
        ("gb", None, "B", None, 1, None, None, "B"),
    ]


def test_norway_mixes_sizes_and_adds_boxes(make):
    out = _costs(
        make,
        [{"id": "r", "unique_recipe_code": "U", "market": "no"}],
        [
            {"recipe_id": "r", "code": "A", "market": "dkse", "segment_name": "NO", "pick_count": 3.0},
            {"recipe_id": "r", "code": "A", "market": "dkse", "segment_name": "NO", "pick_count": 5.0, "size": 4},
        ],
        [],
        [("no", "no", "A", "NOK", 10.0, 2.0)],
        [{"code": "A", "boxitem": 6.0}, {"code": "A", "boxitem": 6.0}, {"code": "A", "boxitem": 8.0}],
    )
    # Two equal box rows double that group; another number of items is a group of its own.
    assert out == [("no", "NOK", "A | A", 14.0, 1, 3 * 30.0, 3 * 10.0, "")]


def test_france_is_stacked_from_both_routes(make):
    recipe = {"id": "r", "unique_recipe_code": "U", "market": "fr"}
    line = {"recipe_id": "r", "code": "A", "market": "fr", "segment_name": "FR"}
    price = [("market", "fr", "A", "EUR", 4.0, 4.0)]
    row = ("fr", "EUR", "A", None, 1, 4.0, 4.0, "")
    assert _costs(make, [recipe], [line], [{"id": "1", "code": "A", "market": "beneluxfr"}], price) == [row]
    assert _costs(make, [recipe], [line], [{"id": "1", "code": "A", "market": "fr"}], price) == [row, row]


# --- tags ---


def _tags(spark, rules, preference, country="GB", protein=None):
    df = spark.createDataFrame([(preference, country, protein)], "preference string, country string, mainprotein string")
    row = with_preferences(df, rules).first()
    return {c for c in TAG_COLUMNS if row[c]}, row["Category_Check"], row["cross_preferences"]


def test_tag_sets_differ_by_branch(spark):
    assert _tags(spark, POOL_RULES, "x", protein="Salmon")[0] == {"Pescatarian"}
    assert _tags(spark, DEMAND_RULES, "x", protein="Salmon")[0] == set()
    assert _tags(spark, SLOT_RULES, "Meat & Veggies")[0] == {"Classic", "Veggie"}
    assert _tags(spark, DEMAND_RULES, "Balanced")[0] == set()
    assert _tags(spark, SLOT_RULES, "Balanced")[0] == {"Calorie_Smart"}
    assert _tags(spark, POOL_RULES, "Fleisch & GemÃ¼se")[0] == {"Classic"}
    assert _tags(spark, DEMAND_RULES, "Fleisch & GemÃ¼se")[0] == set()


def test_tag_texts_over_match_as_they_are(spark):
    assert _tags(spark, POOL_RULES, "Classics") == (
        {"Calorie_Smart", "Classic"}, "AT_LEAST_1", "Calorie Smart, Classic",
    )
    assert _tags(spark, POOL_RULES, "where")[0] == {"Carb_Smart"}
    assert _tags(spark, POOL_RULES, "F")[0] == set()
    assert _tags(spark, POOL_RULES, "x, F,", country="BNL")[0] == {"Family"}
    assert _tags(spark, POOL_RULES, "x, F,", country="BENELUX")[0] == set()
    assert _tags(spark, POOL_RULES, None) == ({"Classic"}, "EMPTY_PREFERENCE", "EMPTY_PREFERENCE")
    assert _tags(spark, POOL_RULES, "")[0] == {"Classic"}
    assert _tags(spark, POOL_RULES, "EMPTY_PREFERENCE") == (set(), "AT_LEAST_1", "")


# --- demand ---


def test_menu_window(make, calendar):
    out = plans.menu_window(
        make(
            "menu",
            {"id": "now"},
            {"id": "now"},
            {"id": "old", "delivery_week": "2024-W08"},
            {"id": "too old", "delivery_week": "2024-W07"},
            {"id": "future", "delivery_week": "2024-W26"},
            {"id": "unknown week", "delivery_week": "2025-W01"},
            {"id": "draft", "status": "draft"},
            {"id": "addon", "item_type": "addon"},
            {"id": "no type", "item_type": None},
            {"id": "green", "brand_name": "Green Chef"},
            {"id": "dk", "market": "dkse", "region_code": "dk"},
            {"id": "se", "market": "dkse", "region_code": "se"},
            {"id": "no", "market": "dkse", "region_code": "no"},
            {"id": "es", "market": "es"},
            {"id": "ck", "market": "ca", "slot_number": 51},
            {"id": "ca", "market": "ca", "slot_number": 1000},
            {"id": "ck2", "market": "ca", "slot_number": 4001},
        ),
        calendar,
        AS_OF,
    )
    assert rows(out.select("id_menu", "market")) == [
        ("ca", "ca"), ("ck", "ck"), ("ck2", "ck"), ("future", "gb"), ("no", "no"), ("now", "gb"),
        ("old", "gb"), ("se", "dkse"),
    ]


def test_slot_preferences(make):
    out = plans.slot_preferences(
        make(
            "slot_preference",
            {"recipe_preference": "Family", "delivery_week": "2024-W01"},
            {"recipe_preference": "Quick"},
            {"recipe_preference": "Rapid"},
            {"recipe_preference": "Specials", "slot": 2},
            {"recipe_preference": None, "slot": 3},
            {"recipe_preference": "", "slot": 4},
            {"recipe_preference": "zzz", "slot": 5},
            {"recipe_preference": "Vegan", "slot": None},
            {"country": "DK"},
            {"country": "BE"},
            {"country": "FR", "year_quarter": "2021-Q4"},
        )
    )
    assert rows(out.select("country", "slot", "preference_slot")) == [
        ("benelux", 1, "Family"), ("dkse", 1, "Family"), ("gb", 1, "Quick and Easy"),
        ("gb", 4, "EMPTY_PREFERENCE"), ("gb", 5, ""),
    ]


# --- the whole ---


@pytest.fixture(scope="session")
def tables(spark):
    def recipe(number, market, **more):
        return {
            "id": f"{market}{number}", "market": market, "recipe_code": f"RC{number}",
            "unique_recipe_code": f"U-{market}{number}", **more,
        }

    def line(market, number, segment, code, picks):
        return {
            "recipe_id": f"{market}{number}", "market": market, "segment_name": segment,
            "code": code, "name": f"{code}\n", "pick_count": picks,
        }

    return market(
        spark,
        recipe=[
            recipe(1, "gb", target_preferences="Family, Quick", title="A\tpie"),
            recipe(2, "gb", target_preferences=None, primary_protein="Salmon", main_protein="Fish", hands_on_time=""),
            recipe(3, "gb", title="Test pie"),
            recipe(4, "gb"),
            recipe(1, "it", primary_protein=None, is_default=1, hands_on_time_max="7", hands_off_time_max=None),
            recipe(1, "dkse", target_preferences="zzz"),
            recipe(1, "benelux", target_preferences="x, F,"),
        ],
        picklist=[
            line("gb", 1, "GR", "A", 1.0),
            line("gb", 2, "GR", "A", 2.0),
            line("gb", 3, "GR", "A", 2.0),
            line("gb", 4, "GR", "B", 1.0),
            line("it", 1, "IT", "A", 1.0),
            line("dkse", 1, "SE", "A", 1.0),
            line("dkse", 1, "NO", "A", 3.0),
            line("benelux", 1, "NL", "A", 1.0),
        ],
        sku=[
            {"id": f"{m}-A", "code": "A", "market": m} for m in ("gb", "it", "dkse", "beneluxfr")
        ] + [{"id": "gb-B", "code": "B"}],
        sku_price=[
            {"culinary_sku_id": "gb-A"},
            {"culinary_sku_id": "gb-B", "price": 0.75},
            {"culinary_sku_id": "it-A", "distribution_center": "IT", "currency": "EUR"},
            {"culinary_sku_id": "dkse-A", "distribution_center": "SK", "currency": "SEK"},
            {"culinary_sku_id": "dkse-A", "distribution_center": "MO", "currency": "NOK", "price": 2.0},
            {"culinary_sku_id": "beneluxfr-A", "distribution_center": "DH", "currency": "EUR", "price": 3.125},
        ],
        recipe_scores=[
            {"score": 4.0},
            {"country": "NL", "region": "BNLF", "score": 2.0},
        ],
        recipe_usage=[
            {"market": "gb", "region_code": r, "recipe_code": "RC1", "last_used": "2024-W01", "absolute_last_used": None}
            for r in ("a", "b")
        ] + [{"market": "gb", "region_code": "a", "recipe_code": "RC2", "absolute_last_used": "2024-W02", "is_newrecipe": 0}],
        segment_nutrition=[
            {"market": "gb", "segment": "GR", "country": "GB", "recipe_id": "gb1", "energy": 500.0, "carbs": 0.0},
        ],
        menu=[
            {"unique_recipe_code": "U-gb4", "recipe_id": "ignored", "delivery_week": "2024-W15"},
            {"unique_recipe_code": "U-gb4", "slot_number": 2},
            {"unique_recipe_code": "U-gb4", "slot_number": 3},
            {"unique_recipe_code": "U-gb4", "slot_number": 4},
            {"unique_recipe_code": "unknown"},
            {"unique_recipe_code": "U-dkse1", "market": "dkse", "region_code": "no"},
        ],
        slot_preference=[
            {"recipe_preference": "Family"},
            {"recipe_preference": "zzz", "slot": 2},
            {"recipe_preference": "", "slot": 3},
            {"recipe_preference": "Family", "country": "NO"},
        ],
    )


@pytest.fixture(scope="session")
def pool(tables):
    return plans.recipe_pool(tables, AS_OF).cache()


def test_pool_rows_and_tags(pool):
    found = pool.filter("source = 'Recipe Pool'").select("recipe_id", "country", "Preferences", "cross_preferences")
    family = "Family, Quick and Easy"
    # Two usage regions with equal values make one row after the distinct; two
    # currencies make two. gb3 is a test, gb4 costs just the British minimum.
    assert rows(found) == [
        ("benelux1", "BENELUX", "EMPTY_PREFERENCE", ""),
        ("dkse1", "DKSE", "EMPTY_PREFERENCE", ""),
        ("dkse1", "DKSE", "EMPTY_PREFERENCE", ""),
        ("dkse1", "NO", "EMPTY_PREFERENCE", ""),
        ("gb1", "GB", "Family", family),
        ("gb1", "GB", "Quick and Easy", family),
        ("gb2", "GB", "Classic", "EMPTY_PREFERENCE"),
        ("gb2", "GB", "Pescatarian", "EMPTY_PREFERENCE"),
        ("it1", "IT", "Classic", "Classic"),
    ]


def test_pool_values(pool):
    by_id = {(r.recipe_id, r.country): r for r in pool.filter("source = 'Recipe Pool'").collect()}
    gb1, gb2 = by_id["gb1", "GB"], by_id["gb2", "GB"]
    assert (gb1.title, gb1.calories, gb1.carbohydrates, gb1.totaltime) == ("Apie", 500.0, 999.0, 15.0)
    assert (gb1.lastused, gb1.absolutelastused, gb1.isnewrecipe, gb1.isnewscheduled) == ("2024-W01", "", 1, 0)
    assert (gb2.absolutelastused, gb2.isnewrecipe, gb2.totaltime, gb2.calories) == ("2024-W02", 0, 104.0, 999.0)
    assert (gb1.skucode, gb1.skuname, gb1.skucount, gb1.currency) == ("A", "A", 1, "GBP")
    # The price counts in every quarter under one reading and only in this one
    # under the other. The readings differ in the next price, so both add up.
    assert (gb1.cost2p_current, gb1.cost2p_next) == (8.0, 4.0)
    assert (gb2.cost2p_current, gb2.cost2p_next) == (16.0, 8.0)
    assert by_id["it1", "IT"].totaltime == 106.0
    assert by_id["benelux1", "BENELUX"].cost2p_current == 3.13
    assert by_id["dkse1", "NO"].cost2p_current == 6.0
    assert (gb1.delivery_week, gb1.slot_number) == (None, None)


def test_missing_scores(pool):
    scores = {
        (r.recipe_id, r.country): (r.scorewoscm, r.scorescm, r.isscorereplace)
        for r in pool.filter("source = 'Recipe Pool'").collect()
    }
    assert scores["gb1", "GB"] == (4.0, 3.0, 0)
    # Benelux recipes never meet their scores; the mean of all beef recipes stands in.
    assert scores["benelux1", "BENELUX"] == (4.0, 3.0, 1)
    # No protein of its own, but a main protein with a mean.
    assert scores["it1", "IT"] == (4.0, 3.0, 1)
    assert scores["gb2", "GB"] == (3.4, 3.4, 1)


def test_demand_rows(pool):
    found = pool.filter("source = 'Demand'").select("recipe_id", "country", "slot_number", "delivery_week", "preference", "Preferences")
    # A preference without a tag reads as no preference and becomes Classic; an
    # empty one becomes a text that no rule knows. Slot 4 has no preference.
    assert rows(found) == [
        ("dkse1", "NO", 1, "2024-W20", "Family", "Family"),
        ("gb4", "GB", 1, "2024-W15", "Family", "Family"),
        ("gb4", "GB", 2, "2024-W20", "", "Classic"),
        ("gb4", "GB", 3, "2024-W20", "EMPTY_PREFERENCE", "EMPTY_PREFERENCE"),
    ]


def test_result_shape_and_order(pool, tables):
    assert len(pool.columns) == 57
    order = [(r.country, r.uniquerecipecode) for r in pool.collect()]
    assert order == sorted(order)
    assert not [f.name for f in pool.schema.fields if f.dataType.typeName() == "void"]


def test_week_column_name(tables, pool):
    renamed = {
        role: df.withColumnRenamed("delivery_week", "my_week").withColumn("unread", F.lit(1))
        for role, df in tables.items()
    }
    out = plans.recipe_pool(renamed, AS_OF, week_column="my_week")
    assert out.columns == [c.replace("delivery_week", "my_week") for c in pool.columns]
    assert rows(out) == rows(pool)


def test_one_day_counts_as_today_everywhere(tables, pool, monkeypatch):
    """Without ``as_of`` the day is taken once, before anything is planned."""
    days = iter([AS_OF, "2024-06-30"])
    module = importlib.import_module("larder.plans.recipe_pool")
    monkeypatch.setattr(module, "today", lambda spark: next(days))
    out = plans.recipe_pool(tables, sort=False)
    assert "current_timestamp" not in out._jdf.queryExecution().toString()
    assert rows(out) == rows(out) == rows(pool)


def test_recipes_without_a_code_share_no_cost(make, calendar):
    recipes = make("recipe", *({"id": f"r{i}", "unique_recipe_code": None} for i in range(50)), {"id": "a", "unique_recipe_code": "C-1"})
    lines = make("picklist", *({"recipe_id": f"r{i}", "code": f"S{i}"} for i in range(50)), {"recipe_id": "a", "code": "S1"})
    skus = make("sku", {"id": "s1", "code": "S1"})
    prices = plans.sku_prices(make("sku_price", {"culinary_sku_id": "s1"}), skus, calendar, AS_OF)
    ready = plans.ready_recipes(recipes).dropna(subset=["unique_recipe_code"])
    costs = plans.picklist_costs(ready, lines, skus, prices, make("box_item"))
    assert {r.unique_recipe_code for r in costs.collect()} == {"C-1"}


def test_only_columns_that_are_read_are_staged(spark, tmp_path, monkeypatch):
    """Of the joined orders and order lines; and what is cut from them has all its columns."""
    market_tables, staged = importlib.import_module("workload.market_tables"), {}
    sf_dir, own = "/root/testdata/sf0.001", market_tables.stage
    whole = {name: df.columns for name, df in market_tables.market_tables(spark, sf_dir).items()}

    def noted(df, label):
        staged[label] = df.columns
        return own(df, label)

    monkeypatch.setattr(market_tables, "stage", noted)
    cut = market_tables.market_tables(spark, sf_dir, "recipe", "sku_price", "sku", "calendar", "picklist", "box_item")
    assert {name: df.columns for name, df in cut.items()} == {name: whole[name] for name in cut}
    assert {"l_orderkey", "l_discount", "ucode", "rcode"}.isdisjoint(staged["recipe_lines"])
    assert {"rid", "ucode", "rcode", "mkt", "o_orderkey"} <= set(staged["recipe_orders"])


def test_each_step_of_the_pool_is_written_before_the_next_is_shuffled(spark, monkeypatch):
    """So the shuffles of prices, picklists and scores never lie on the disks together."""
    from larder.plans import picklists
    from larder.plans import pool as pool_plan
    from workload import market_queries, market_tables

    steps = []
    for module in (market_tables, picklists, pool_plan):
        own, freed = module.stage, module.release
        monkeypatch.setattr(module, "stage", lambda df, label, own=own: (steps.append((label, df)), own(df, label))[1])
        monkeypatch.setattr(module, "release", lambda s, freed=freed: (steps.append(("release", None)), freed(s)))
    rows = market_queries.market_pool_recipes(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0
    labels = [label for label, _ in steps]
    wanted = ["recipe_lines", "release", "routed-skus", "release", "eligible", "release", "pool", "release"]
    assert [label for label in labels[labels.index("recipe_lines") :] if label in wanted] == wanted
    read = {label: df.inputFiles() for label, df in steps if df is not None}
    assert any("/recipe_lines-" in f for f in read["routed-skus"]) and any("/routed-skus-" in f for f in read["eligible"])
    assert any("/eligible-" in f for f in read["pool"]) and not any("/routed-skus-" in f or "/sku-" in f for f in read["pool"])
