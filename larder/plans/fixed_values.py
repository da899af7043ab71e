"""Codes, word lists and constants that define the recipe pool.

All of them are fixed values: results depend on each one.
"""

from __future__ import annotations

# Recipe statuses that are ready for a menu, by market.
READY_STATUSES = {
    "dkse": ("ready for menu planning",),
    "no": ("ready for menu planning",),
    "ie": ("ready for menu planning",),
    "gb": ("ready for menu planning", "in development", "final cook", "external testing"),
    "it": ("ready for menu planning", "in development"),
    "benelux": ("ready for menu planning", "under improvement"),
    "fr": ("ready for menu planning", "planned"),
}

# Markets whose planners use the default version, not the newest.
DEFAULT_VERSION_MARKETS = ("ie", "it")

# Add-on recipes that never enter the pool.
EXCLUDED_PRODUCT_PATTERNS = ("add-ons%", "addon%", "gc-%", "%gc-%")
EXCLUDED_PRODUCTS = ("1.2-nl-only",)
EXCLUDED_RECIPE_TYPE_PATTERNS = ("addon%", "Add on%", "Add-on%", "Add-On%")

# Limits a score must exceed, as (column, values, rating count).
SCORE_RULES = (
    ("country", ("IT", "IE"), 0),
    ("region", ("NO",), 10),
    ("region", ("DK", "SE"), 50),
    ("region", ("BNLF",), 0),
)
GB_SCORE_RATINGS = 100
GB_SEPARATE_SUFFIXES = ("FR", "CH", "DK")

# Markets whose usage rows count in every region.
USAGE_MARKETS = ("it", "ie", "benelux", "es", "fr")

# Recipe prices, week range and distribution center by segment.
RECIPE_PRICE_WEEKS = ("2023-W30", "2023-W43")
RECIPE_PRICE_ANY_CENTER = ("IT", "IE")
RECIPE_PRICE_CENTERS = {"NL": "DH", "SE": "SK", "GR": "GR", "NO": "MO", "FR": "DH"}

# SKU prices that count in every quarter.
ALWAYS_PRICED_MARKETS = ("it", "ie", "beneluxfr", "es")
ALWAYS_PRICED_CENTERS = {"dkse": "SK", "gb": "GR"}
NO_PRICE_CENTER = "MO"

# Picklist segment that prices a market's recipes.
PICKLIST_SEGMENTS = {"dkse": "SE", "gb": "GR", "benelux": "NL", "fr": "FR"}
PICKLIST_ANY_SEGMENT = ("ie", "it")

# What a recipe needs to enter the pool.
PROTEIN_REQUIRED_MARKETS = ("ie", "dkse", "no", "benelux", "fr")
COST_ONLY_MARKETS = ("it", "es")
NO_PROTEIN = "N/A"
GB_MINIMUM_COST = 1.5
GB_EXCLUDED_PROTEINS = ("White Fish - Coley", "N/A")
GB_EXCLUDED_TITLES = ("%not use%", "%wrong%", "%test%", "%brexit%")
GB_EXCLUDED_CODES = ("%MOD%", "%ASD%", "GC%", "A%", "X%")
GB_EXCLUDED_PRODUCTS = (
    "add-on",
    "Baking kits",
    "Breakfast",
    "Sides",
    "Dessert",
    "Bread",
    "Brunch",
    "Cheese",
    "Desserts",
    "Modularity",
    "Ready Meals",
    "Speedy lunch",
    "Speedy Lunch",
    "Soup",
)

# Stand-ins for missing numbers.
MISSING_NUTRITION = 999.0
MISSING_MINUTES = 99.0
MISSING_SCORE = 3.4
MAXIMUM_MINUTES_MARKETS = ("jp", "it")

# The menus that count as demand.
DEMAND_WEEKS = 12
EXCLUDED_ITEM_TYPE = "addon"
EXCLUDED_BRAND = "Green Chef"
EXCLUDED_REGION = "dk"
EXCLUDED_MENU_STATUS = "draft"
EXCLUDED_MARKETS = ("es", "jp")

# Slot preferences.
SLOT_YEARS_AFTER = "2021"
EXCLUDED_SLOT_PREFERENCES = (
    "Premium",
    "Premium Upcharge - Chef Choice",
    "Premium Upcharge - Keto",
    "Specials",
    "Surcharges",
)

# Tags as (column, label), in output order.
TAGS = (
    ("Calorie_Smart", "Calorie Smart"),
    ("Carb_Smart", "Carb Smart"),
    ("Classic", "Classic"),
    ("Discovery", "Discovery"),
    ("Family", "Family"),
    ("Pescatarian", "Pescatarian"),
    ("Quick_and_Easy", "Quick and Easy"),
    ("Vegan", "Vegan"),
    ("Veggie", "Veggie"),
)

# Texts that earn a tag. An underscore stands for any character.
TAG_TEXTS = {
    "Calorie_Smart": (
        "calorie_smart",
        "cs",
        "calorie smart",
        "unter 650 kalorien",
        "conta calorie",
        "calorie limited",
        "healthy",
    ),
    "Carb_Smart": ("low carb", "carb smart", "here"),
    "Classic": (
        "c3_appropriate",
        "classic",
        "fleisch & gemüse",
        "carne & pesce",
        "chef's choice",
        "cl",
        "fish free",
        "pork free",
        "keto",
        "gluten free",
    ),
    "Discovery": ("discovery",),
    "Family": ("family friendly", "family", "familienfreundlich", "famiglia"),
    "Pescatarian": ("pescatarian",),
    "Quick_and_Easy": ("quick", "quick & easy", "rapid", "easy"),
    "Vegan": ("vegan",),
    "Veggie": ("vegetarian", "veggie", "vegetarisch", "vegetariano"),
}

# Texts that earn a tag in the pool only.
POOL_TAG_TEXTS = {"Classic": ("fleisch & gemã¼se",)}
POOL_PESCATARIAN_PROTEINS = ("Fish", "White Fish", "Seafood", "Salmon", "Shellfish")

# Texts that earn a tag for menu slots only.
SLOT_TAG_TEXTS = {
    "Calorie_Smart": ("balanced",),
    "Carb_Smart": ("carb limited",),
    "Classic": (
        "chef choice",
        "beef free",
        "everyday favorites",
        "flexible",
        "flexitarian",
        "helloextra",
        "high protein",
        "meat & veggies",
        "mix",
        "pork & fish free",
        "protein rich",
        "protein increase",
        "seafood free",
        "shellfish free",
        "static",
    ),
    "Pescatarian": ("pescaterian",),
}

# Endings that earn a tag in one country only.
LOCAL_TAG_COUNTRY = "BNL"
LOCAL_TAG_ENDINGS = {"Family": "f,", "Quick_and_Easy": "q,", "Veggie": "v,"}
