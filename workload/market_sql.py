"""SQL that checks the market queries.

Written row by row on day-grain joins, where the plans combine rows early, so
that both have to agree on what a row counts for.
"""

from __future__ import annotations

from workload import expected_values as fixed
from workload.market_tables import AS_OF, RECIPE_PRICE_WEEKS, SLOT_YEARS_AFTER, market_ctes


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _in(column: str, values) -> str:
    return f"{column} in ({', '.join(map(_text, values))})"


def _unlike(column: str, patterns) -> str:
    return " and ".join(f"{column} not like {_text(p)}" for p in patterns)


def _ready(market: str, markets) -> str:
    arms = (
        f"({market} = {_text(m)} and {_in('lower(status)', fixed.READY_STATUSES[m])})"
        for m in markets
    )
    return "(" + " or ".join(arms) + ")"


def _tagged(extra_texts, pescatarian_extra="") -> str:
    """Select list: one column per tag, the check label and the joined list."""
    columns = []
    for column, label in fixed.TAGS:
        texts = (*fixed.TAG_TEXTS[column], *extra_texts.get(column, ()))
        arms = [f"lower(preference) like {_text(f'%{t}%')}" for t in texts]
        if column == "Classic":
            arms += ["preference is null", "preference = ''"]
        if column == "Pescatarian" and pescatarian_extra:
            arms.append(pescatarian_extra)
        if column in fixed.LOCAL_TAG_ENDINGS:
            ending = _text("%" + fixed.LOCAL_TAG_ENDINGS[column])
            arms.append(
                f"(country = '{fixed.LOCAL_TAG_COUNTRY}' and lower(preference) like {ending})"
            )
        columns.append(f"case when {' or '.join(arms)} then {_text(label)} end as {column}")
    names = ", ".join(column for column, _ in fixed.TAGS)
    blank = "preference is null or preference = ''"
    return (
        ", ".join(columns)
        + f", case when {blank} then 'EMPTY_PREFERENCE' else 'AT_LEAST_1' end as Category_Check"
        + f", case when {blank} then 'EMPTY_PREFERENCE' else concat_ws(', ', {names}) end"
        + " as cross_preferences"
    )


def _quarter_mean(market: str, condition: str, offset: int, out: str, currency: bool) -> str:
    condition = condition.format(quarter=f"(running_quarter = (select q + {offset} from today))")
    extra = ", currency" if currency else ""
    return (
        f"select {market} as market, code{extra}, avg(price) as {out} "
        f"from price_days where {condition} group by all"
    )


def _price_pair(scope: str, market: str, condition: str) -> str:
    current = _quarter_mean(market, condition, 0, "current_quarter_avg_sku_price", True)
    following = _quarter_mean(market, condition, 1, "next_quarter_avg_sku_price", False)
    return (
        f"select '{scope}' as scope, a.market, a.code, a.currency, "
        "a.current_quarter_avg_sku_price, b.next_quarter_avg_sku_price "
        f"from ({current}) a left join ({following}) b on a.market = b.market and a.code = b.code"
    )


_ALWAYS = " or ".join(
    [
        _in("market", fixed.ALWAYS_PRICED_MARKETS),
        *(
            f"(market = '{m}' and center = '{c}')"
            for m, c in fixed.ALWAYS_PRICED_CENTERS.items()
        ),
    ]
)

_SEGMENTS = " or ".join(
    [
        _in("r.market", fixed.PICKLIST_ANY_SEGMENT),
        *(
            f"(r.market = '{m}' and p.segment_name = '{s}')"
            for m, s in fixed.PICKLIST_SEGMENTS.items()
        ),
    ]
)


def _route(name: str, joins: str, where: str, next_size: int, boxitem: str = "null") -> str:
    return f"""
        select '{name}' as route, r.unique_recipe_code, r.market, c.currency, p.code,
            translate(p.name, chr(9) || chr(10), '') as name, cast({boxitem} as double) as boxitem,
            case when c.current_quarter_avg_sku_price is null
                or c.current_quarter_avg_sku_price = 0 then p.code end as missing,
            case when p.size = 2 then p.pick_count * c.current_quarter_avg_sku_price else 0 end
                as current_cost,
            case when p.size = {next_size} then p.pick_count * c.next_quarter_avg_sku_price
                else 0 end as next_cost
        from ready r join picklist p on r.id = p.recipe_id {joins} where {where}"""


def _master(joint: str) -> str:
    return (
        "and r.market = p.market join (select code, case market when 'beneluxfr' then "
        f"'{joint}' else market end as market from sku) k on k.code = p.code and "
        "k.market = p.market left join (select * from market_sku_prices where scope = 'market') c "
        "on c.code = p.code and c.market = p.market"
    )


_GB_RULE = " and ".join(
    [
        "market = 'gb'",
        "length(primary_protein) > 0",
        f"not {_in('primary_protein', fixed.GB_EXCLUDED_PROTEINS)}",
        f"cost2p_current > {fixed.GB_MINIMUM_COST}",
        _unlike("lower(title)", fixed.GB_EXCLUDED_TITLES),
        _unlike("unique_recipe_code", fixed.GB_EXCLUDED_CODES),
        f"not {_in('target_products', fixed.GB_EXCLUDED_PRODUCTS)}",
    ]
)


def _minutes(column: str) -> str:
    return f"case when {column} is null or {column} = '' then 99 else cast({column} as float) end"


def _filled(column: str) -> str:
    means = ", ".join(
        f"avg({column}) over (partition by {protein})"
        for protein in ("primary_protein", "main_protein")
    )
    return f"round(coalesce({column}, {means}, {fixed.MISSING_SCORE}), 6) as {column}"


# Output columns that demand rows fill, with where they come from.
_DEMAND_COLUMNS = {
    "recipe_id": "r.id",
    "country": "upper(m.market)",
    "uniquerecipecode": "m.unique_recipe_code",
    "code": "r.recipe_code",
    "version": "r.version",
    "status": "r.status",
    "title": "r.title",
    "slot_number": "m.slot_number",
    "menu_status": "m.menu_status",
    "primaryprotein": "r.primary_protein",
    "mainprotein": "r.main_protein",
    "proteincut": "r.protein_cut",
    "primarystarch": "r.primary_starch",
    "mainstarch": "r.main_starch",
    "primaryvegetable": "r.primary_vegetable",
    "mainvegetable": "r.main_vegetable",
    "cuisine": "r.cuisine",
    "dishtype": "r.dish_type",
    "tag": "r.tags",
    "preference": "s.preference_slot",
    "producttype": "r.target_products",
    "recipetype": "r.recipe_type",
    "created_at": "r.created_at",
    "updated_at": "r.updated_at",
    "source": "'Demand'",
    "delivery_week": "m.delivery_week",
}

_SQL_TYPES = {"string": "varchar", "integer": "int", "long": "bigint"}


def _demand_select() -> str:
    columns = (column.split() for column in fixed.RESULT_COLUMNS.split(", "))
    return ", ".join(
        f"cast({_DEMAND_COLUMNS.get(name, 'null')} as {_SQL_TYPES.get(kind, kind)}) as {name}"
        for name, kind in columns
    )


_STAGES = {
    "score_rows": f"""
        select *, 'country' as ranking, country as area, '' as suffix,
            case when region in ('DK', 'SE') then 'DKSE' when region = 'NO' then 'NO'
                when country in ('BE', 'NL', 'LU') then 'BNL' else country end as market
        from recipe_scores where score > 0 and ({" or ".join(
            f"({_in(column, values)} and rating_count > {ratings})"
            for column, values, ratings in fixed.SCORE_RULES)})
        union all
        select *, 'suffix', region, case when {_in("right(uniquerecipecode, 2)",
            fixed.GB_SEPARATE_SUFFIXES)} then right(uniquerecipecode, 2) else 'X' end, country
        from recipe_scores
        where score > 0 and region = 'GB' and rating_count > {fixed.GB_SCORE_RATINGS}""",
    "market_scores": """
        select market as country, mainrecipecode,
            sum(score * rating_count) / nullif(sum(rating_count), 0) as scorewoscm,
            sum(score_wscm * rating_count_wscm) / nullif(sum(rating_count_wscm), 0) as scorescm
        from (select * from score_rows qualify rank() over (
            partition by ranking, area, suffix, mainrecipecode
            order by delivery_week desc nulls last) = 1)
        group by all""",
    "market_usage": f"""
        select *, if(market = 'dkse' and region_code = 'no', 'no', market) as country_final_id
        from recipe_usage where region_code <> 'dk' or market = 'gb'
            or ({_in("market", fixed.USAGE_MARKETS)} and region_code is not null)""",
    "market_nutrition": """
        select *, if(market = 'dkse' and segment = 'NO', 'no', market) as country_final_id
        from segment_nutrition where (country = 'GB' and market = 'gb')
            or (segment not in ('DK', 'JP') and country <> 'ES')""",
    "market_recipe_price": f"""
        select case segment when 'GR' then 'GB' when 'SE' then 'DKSE' when 'NL' then 'BNL'
            else segment end as segment, recipe_id, size, avg(price) as cost
        from recipe_price
        where delivery_week between '{RECIPE_PRICE_WEEKS[0]}' and '{RECIPE_PRICE_WEEKS[1]}'
            and ({_in("segment", fixed.RECIPE_PRICE_ANY_CENTER)} or {" or ".join(
                f"(segment = '{s}' and distribution_center = '{c}')"
                for s, c in fixed.RECIPE_PRICE_CENTERS.items())})
        group by all""",
    "today": f"""
        select max(running_quarter) as q, max(running_week) as w
        from calendar where date_string_backwards = '{AS_OF}'""",
    "price_days": """
        select p.price, p.currency, p.distribution_center as center, s.market, s.code,
            c.running_quarter
        from sku_price p left join sku s on s.id = p.culinary_sku_id
            left join calendar c on c.delivery_week = p.delivery_week""",
    "market_sku_prices": " union ".join(
        [
            _price_pair(
                "market",
                "if(market = 'beneluxfr', 'benelux', market)",
                "({quarter} or " + _ALWAYS + ")",
            ),
            _price_pair(
                "market",
                "if(market = 'beneluxfr', 'fr', market)",
                "({quarter} or market = 'beneluxfr')",
            ),
            _price_pair(
                "no",
                "'no'",
                "({quarter} and market = 'dkse' and center = '" + fixed.NO_PRICE_CENTER + "')",
            ),
        ]
    ),
    "ready_versions": f"""
        select * from recipe
        where {_ready("market", [m for m in fixed.READY_STATUSES if m != "no"])}
            and (market <> 'gb' or is_default = 1)
        qualify case when {_in("market", fixed.DEFAULT_VERSION_MARKETS)} then is_default = 1
            else rank() over (partition by recipe_code, market order by version desc) = 1 end""",
    "ready": """
        select * from ready_versions
        union all by name
        select * replace ('no' as market) from ready_versions where market = 'dkse'""",
    "market_poolable_recipes": f"""
        select * from ready
        where {_unlike("target_products", fixed.EXCLUDED_PRODUCT_PATTERNS)}
            and not {_in("target_products", fixed.EXCLUDED_PRODUCTS)}
            and {_unlike("recipe_type", fixed.EXCLUDED_RECIPE_TYPE_PATTERNS)}""",
    "priced_lines": " union all ".join(
        [
            _route("shared", _master("benelux"), _SEGMENTS, 2),
            _route("france", _master("fr"), "r.market = 'fr' and p.segment_name = 'FR'", 2),
            _route(
                "norway",
                "left join (select * from market_sku_prices where scope = 'no') c "
                "on c.code = p.code left join box_item b on b.code = p.code",
                "r.market = 'no' and p.segment_name = 'NO'",
                4,
                "b.boxitem",
            ),
        ]
    ),
    "priced_items": """
        select route, unique_recipe_code, market, currency, code, name, missing, boxitem,
            sum(current_cost) as current_cost, sum(next_cost) as next_cost
        from priced_lines group by all""",
    "costs": """
        select unique_recipe_code, market, currency,
            string_agg(code, ' | ' order by code, name, missing nulls first) as skucode,
            string_agg(name, ' | ' order by code, name, missing nulls first) as skuname,
            cast(count(distinct code) as bigint) as skucount,
            sum(current_cost) as cost2p_current, sum(next_cost) as cost2p_next,
            if(route = 'norway', sum(coalesce(boxitem, 0)), null) as boxitem,
            coalesce(string_agg(missing, ' | ' order by missing), '') as pricemissingskus
        from priced_items group by route, unique_recipe_code, market, currency""",
    "market_picklist_costs": """
        select * replace (round(cost2p_current, 4) as cost2p_current,
            round(cost2p_next, 4) as cost2p_next) from costs""",
    "pool_rows": f"""
        select r.*, p.currency, p.skucode, p.skuname, p.skucount, p.cost2p_current, p.cost2p_next,
            u.last_used, u.next_used, u.absolute_last_used, u.is_newrecipe, u.is_newscheduled,
            n.energy, n.carbs, s.scorescm, s.scorewoscm
        from market_poolable_recipes r
            left join market_usage u
                on u.recipe_code = r.recipe_code and u.country_final_id = r.market
            left join market_nutrition n on n.recipe_id = r.id and n.country_final_id = r.market
            left join market_scores s
                on s.mainrecipecode = r.recipe_code and lower(s.country) = r.market
            left join costs p
                on p.unique_recipe_code = r.unique_recipe_code and p.market = r.market""",
    "market_pool_recipes": f"""
        select id as recipe_id, upper(market) as country, unique_recipe_code as uniquerecipecode,
            recipe_code as code, version, status,
            translate(title, chr(9) || chr(10), '') as title,
            cast(null as int) as slot_number, cast(null as varchar) as menu_status,
            last_used as lastused, next_used as nextused,
            coalesce(absolute_last_used, '') as absolutelastused,
            coalesce(is_newrecipe, 1) as isnewrecipe,
            coalesce(is_newscheduled, 0) as isnewscheduled, is_default as isdefault,
            primary_protein as primaryprotein, main_protein as mainprotein,
            protein_cut as proteincut, primary_starch as primarystarch,
            main_starch as mainstarch, coalesce(primary_vegetable, 'none') as primaryvegetable,
            main_vegetable as mainvegetable, currency,
            coalesce(nullif(energy, 0), 999) as calories,
            coalesce(nullif(carbs, 0), 999) as carbohydrates,
            cuisine, dish_type as dishtype,
            cast(if({_in("market", fixed.MAXIMUM_MINUTES_MARKETS)},
                {_minutes("hands_on_time_max")} + {_minutes("hands_off_time_max")},
                {_minutes("hands_on_time")} + {_minutes("hands_off_time")}) as float) as totaltime,
            difficulty, tags as tag, target_preferences as preference,
            target_products as producttype, recipe_type as recipetype, created_at, updated_at,
            cast(round(cast(cost2p_current as decimal(30, 10)), 2) as double) as cost2p_current,
            cast(round(cast(cost2p_next as decimal(30, 10)), 2) as double) as cost2p_next,
            {_filled("scorescm")}, {_filled("scorewoscm")},
            if(scorewoscm is null, 1, 0) as isscorereplace,
            skucode, skuname, skucount, 'Recipe Pool' as source,
            cast(null as varchar) as delivery_week
        from pool_rows
        where ({_in("market", fixed.PROTEIN_REQUIRED_MARKETS)} and length(primary_protein) > 0
                and primary_protein <> '{fixed.NO_PROTEIN}' and cost2p_current > 0)
            or ({_in("market", fixed.COST_ONLY_MARKETS)} and cost2p_current > 0)
            or ({_GB_RULE})""",
    "market_menu_window": f"""
        select distinct case
                when m.market = 'ca' and (slot_number between 51 and 999 or slot_number > 4000)
                    then 'ck'
                when region_code = 'se' then 'dkse' when region_code = 'no' then 'no'
                else m.market end as market,
            region_code, slot_number, m.delivery_week, status as menu_status, id as id_menu,
            recipe_id, unique_recipe_code
        from menu m join calendar c on c.delivery_week = m.delivery_week
        where item_type <> '{fixed.EXCLUDED_ITEM_TYPE}' and brand_name <> '{fixed.EXCLUDED_BRAND}'
            and region_code <> '{fixed.EXCLUDED_REGION}'
            and status <> '{fixed.EXCLUDED_MENU_STATUS}'
            and not {_in("m.market", fixed.EXCLUDED_MARKETS)}
            and c.running_week >= (select w - {fixed.DEMAND_WEEKS} from today)""",
    "latest_slots": f"""
        select *, recipe_preference as preference from slot_preference
        where left(year_quarter, 4) > '{SLOT_YEARS_AFTER}'
        qualify rank() over (partition by country order by delivery_week desc nulls last) = 1""",
    "tagged_slots": f"""
        select *, {_tagged(fixed.SLOT_TAG_TEXTS)} from latest_slots
        where not {_in("preference", fixed.EXCLUDED_SLOT_PREFERENCES)}""",
    "market_slot_preferences": """
        select distinct case country when 'DK' then 'dkse' when 'BE' then 'benelux'
            else lower(country) end as country, slot, delivery_week, year_quarter,
            cross_preferences as preference_slot
        from tagged_slots where slot is not null""",
    "demand_made": """
        select * from recipe union all by name
        select * replace ('no' as market) from recipe where market = 'dkse'""",
    "demand_rows": f"""
        select {_demand_select()}
        from market_menu_window m
            join demand_made r
                on r.unique_recipe_code = m.unique_recipe_code and r.market = m.market
            join market_slot_preferences s on s.slot = m.slot_number and s.country = m.market
        where not {_in("m.market", fixed.EXCLUDED_MARKETS)}""",
    # The plan drops the menu's ids first, so its rows are distinct without them.
    "market_demand_recipes": """
        select * from (select distinct * from demand_rows)""",
    "tagged_rows": f"""
        select *, {_tagged(fixed.POOL_TAG_TEXTS, pescatarian_extra=_in(
            "mainprotein", fixed.POOL_PESCATARIAN_PROTEINS))} from market_pool_recipes
        union all
        select *, {_tagged({})} from market_demand_recipes""",
    "recipe_pool": f"""
        select distinct t.*, v.tag as Preferences
        from tagged_rows t join (values {", ".join(
            f"({_text(label)})" for _, label in fixed.TAGS)}, ('EMPTY_PREFERENCE')) v(tag)
            on v.tag in ({", ".join(column for column, _ in fixed.TAGS)})
            or (v.tag = 'EMPTY_PREFERENCE'
                and coalesce({", ".join(column for column, _ in fixed.TAGS)}) is null)
        where {_ready("lower(country)", fixed.READY_STATUSES)}""",
}

# Stages that are queries under another name.
_RESULTS = {"market_ready_recipes": "ready"}


def market_oracles() -> dict[str, str]:
    shared = ",\n".join(f"{name} as ({sql})" for name, sql in [*market_ctes(), *_STAGES.items()])
    results = [name for name in _STAGES if name.startswith("market_")] + ["recipe_pool"]
    named = {name: name for name in results} | _RESULTS
    return {query: f"with {shared}\nselect * from {stage}" for query, stage in named.items()}
