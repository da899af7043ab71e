"""The plans' input tables, derived from the driver's tables.

Every order is a recipe version, its customer the recipe, every order line a
picklist row, a SKU price, a score, a recipe price and a menu slot. The same SQL
text runs in Spark and, as common table expressions, in the checking engine;
names in braces stand for the frames it reads.

Prices are multiples of 8 so that their means stay clear of rounding ties.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from larder.sources import release, stage
from workload.tables import table

AS_OF = "1998-05-15"
SLOT_YEARS_AFTER = "1996"
RECIPE_PRICE_WEEKS = ("1997-W30", "1997-W43")

_READ_OFTEN = ("calendar", "sku")
_DRIVER_TABLES = ("customer", "orders", "lineitem", "part")


def _week(day: str) -> str:
    number = f"cast(floor((extract(doy from {day}) - 1) / 7) as int) + 1"
    return (
        f"cast(extract(year from {day}) as string) || '-W' || "
        f"lpad(cast({number} as string), 2, '0')"
    )


def _day(day: str) -> str:
    parts = [f"lpad(cast(extract({p} from {day}) as string), 2, '0')" for p in ("month", "day")]
    return f"cast(extract(year from {day}) as string) || '-' || {parts[0]} || '-' || {parts[1]}"


_BASE = {
    "recipe_orders": f"""
        select o_orderkey, o_orderdate, o_orderstatus, o_orderpriority, o_totalprice,
            c_name, c_mktsegment,
            'R' || cast(o_orderkey as string) as rid,
            'RC' || cast(o_custkey as string) as rcode,
            case o_orderpriority when '1-URGENT' then 'A' when '2-HIGH' then 'MOD' else 'RC' end
                || cast(o_custkey as string) || '-' || cast(o_orderkey as string) as ucode,
            case when c_nationkey <= 3 then 'dkse' when c_nationkey <= 8 then 'gb'
                when c_nationkey <= 11 then 'it' when c_nationkey <= 14 then 'ie'
                when c_nationkey <= 17 then 'benelux' when c_nationkey <= 20 then 'fr'
                when c_nationkey <= 22 then 'es' when c_nationkey <= 23 then 'jp'
                else 'ca' end as mkt,
            cast(extract(month from o_orderdate) as int) as omonth,
            cast(extract(day from o_orderdate) as int) as oday
        from {{orders}} o join {{customer}} c on o.o_custkey = c.c_custkey""",
    "recipe_lines": f"""
        select l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, l_quantity,
            l_tax, l_discount, r.rid, r.rcode, r.ucode, r.mkt,
            case when r.mkt in ('benelux', 'fr') then 'beneluxfr' else r.mkt end as sku_mkt,
            p.p_name, p.p_brand, p.p_type,
            'SKU' || cast(l_partkey as string) as sku_code,
            8 * floor(l_extendedprice / 800) as unit_price,
            {_week('l_shipdate')} as ship_week
        from {{lineitem}} l
            join {{recipe_orders}} r on l.l_orderkey = r.o_orderkey
            join {{part}} p on l.l_partkey = p.p_partkey""",
}

_TABLES = {
    "recipe_scores": """
        select case mkt when 'dkse' then 'DK' when 'benelux' then
                case l_returnflag when 'A' then 'BE' when 'N' then 'NL' else 'LU' end
                else upper(mkt) end as country,
            case mkt when 'dkse' then
                    case l_returnflag when 'A' then 'SE' when 'N' then 'NO' else 'DK' end
                when 'benelux' then 'BNLF' when 'fr' then 'BNLF' else upper(mkt) end as region,
            rcode as mainrecipecode,
            rcode || case when l_linestatus = 'F' then 'FR' else 'ZZ' end as uniquerecipecode,
            cast(l_linenumber - 1 as double) as score,
            cast(l_quantity * 4 as bigint) as rating_count,
            case when l_tax > 0 then l_linenumber / 2.0 end as score_wscm,
            cast(case when l_returnflag = 'R' then 0 else l_quantity end as bigint)
                as rating_count_wscm,
            ship_week as delivery_week
        from {recipe_lines}""",
    "recipe_usage": """
        select mkt as market,
            case mkt when 'dkse' then case c_mktsegment when 'MACHINERY' then 'se'
                    when 'BUILDING' then 'no' when 'AUTOMOBILE' then 'dk' end
                else case when c_mktsegment <> 'HOUSEHOLD' then mkt end end as region_code,
            rcode as recipe_code,
            max(cast(omonth as string)) as last_used,
            case when c_mktsegment <> 'FURNITURE' then min(cast(oday as string)) end as next_used,
            case when c_mktsegment <> 'MACHINERY' then min(cast(omonth as string)) end
                as absolute_last_used,
            case when c_mktsegment <> 'BUILDING' then 0 end as is_newrecipe,
            case when c_mktsegment <> 'AUTOMOBILE' then 1 end as is_newscheduled
        from {recipe_orders} group by mkt, c_mktsegment, rcode
        union all
        select distinct mkt, 'no', rcode, 'x', 'y', 'z', 1, 0
        from {recipe_orders} where mkt = 'dkse'""",
    "segment_nutrition": """
        select mkt as market,
            case mkt when 'dkse' then case o_orderstatus when 'F' then 'SE' when 'O' then 'NO'
                else 'DK' end else upper(mkt) end as segment,
            case when mkt = 'dkse' then 'SE' else upper(mkt) end as country,
            rid as recipe_id,
            case when omonth = 3 then 0.0 else floor(o_totalprice / 1000) end as energy,
            cast(case when omonth <> 4 then oday end as double) as carbs
        from {recipe_orders}
        union all
        select mkt, 'NO', 'NO', rid, 500.0, 50.0 from {recipe_orders} where mkt = 'dkse'
        union all
        select mkt, 'DK', 'GB', rid, 600.0, 60.0 from {recipe_orders} where mkt = 'gb'""",
    "recipe_price": """
        select case mkt when 'dkse' then case l_returnflag when 'N' then 'NO' else 'SE' end
                when 'gb' then 'GR' when 'benelux' then
                case l_returnflag when 'R' then 'BE' else 'NL' end else upper(mkt) end as segment,
            case mkt when 'dkse' then case l_returnflag when 'N' then 'MO' else 'SK' end
                when 'gb' then 'GR' else case l_linestatus when 'F' then 'DH' else 'XX' end end
                as distribution_center,
            rid as recipe_id,
            case when l_linestatus = 'F' then 2 else 4 end as size,
            case when l_linenumber < 7 then unit_price end as price,
            ship_week as delivery_week
        from {recipe_lines}""",
    "calendar": f"""
        select {_day('d')} as date_string_backwards, {_week('d')} as delivery_week,
            cast(extract(year from d) * 53 + floor((extract(doy from d) - 1) / 7) as int)
                as running_week,
            cast(extract(year from d) * 4 + extract(quarter from d) as int) as running_quarter
        from (select l_shipdate as d from {{lineitem}} union select o_orderdate from {{orders}}) days""",
    "sku_price": """
        select case when l_tax = 0.08 then 'old' when mkt = 'fr' and p_type = 'PROMO'
                and l_returnflag = 'R' then 'fr' else sku_mkt end
                || ':' || cast(l_partkey as string) as culinary_sku_id,
            case mkt when 'dkse' then case l_returnflag when 'N' then 'MO' when 'A' then 'SK'
                else 'XX' end
                when 'gb' then case l_returnflag when 'R' then 'XX' else 'GR' end
                else 'DH' end as distribution_center,
            case when l_tax = 0.07 then '0000-W00' else ship_week end as delivery_week,
            case mkt when 'gb' then 'GBP' when 'dkse' then
                case l_linestatus when 'F' then 'SEK' else 'DKK' end else 'EUR' end as currency,
            case when l_linenumber < 7 then case when l_linenumber > 5 then 0.0
                else unit_price end end as price
        from {recipe_lines}""",
    "sku": """
        select distinct sku_mkt || ':' || cast(l_partkey as string) as id, sku_code as code,
            sku_mkt as market
        from {recipe_lines}
        union all
        select distinct sku_mkt || ':b' || cast(l_partkey as string), sku_code, sku_mkt
        from {recipe_lines} where p_brand = 'Brand#11'
        union all
        select distinct 'fr:' || cast(l_partkey as string), sku_code, 'fr'
        from {recipe_lines} where mkt = 'fr' and p_type = 'PROMO'""",
    "recipe": """
        select rid as id, mkt as market, ucode as unique_recipe_code, rcode as recipe_code,
            cast(extract(year from o_orderdate) as int) as version,
            case o_orderstatus when 'F' then 'Ready for Menu Planning'
                when 'O' then case o_orderpriority when '1-URGENT' then 'In Development'
                    when '2-HIGH' then 'under improvement' when '3-MEDIUM' then 'Planned'
                    when '5-LOW' then 'final cook' else 'External Testing' end
                else case when omonth < 5 then 'ready for menu planning'
                    when omonth < 11 then 'retired' end end as status,
            'Dish' || chr(9) || c_name || chr(10) || case when oday = 8 then 'Test ' else '' end
                || o_orderpriority as title,
            case when o_orderpriority in ('3-MEDIUM', '5-LOW') then 1 else 0 end as is_default,
            case when c_mktsegment = 'AUTOMOBILE' and omonth = 1 then 'N/A'
                when c_mktsegment = 'HOUSEHOLD' and omonth = 2 then null
                when c_mktsegment = 'FURNITURE' and omonth = 3 then ''
                when c_mktsegment = 'BUILDING' and omonth < 4 then 'White Fish - Coley'
                else lower(c_mktsegment) || ' ' || mkt end as primary_protein,
            case o_orderpriority when '1-URGENT' then 'Fish' when '2-HIGH' then 'Beef'
                when '3-MEDIUM' then 'Seafood' when '5-LOW' then 'Tofu' end as main_protein,
            'cut ' || cast(omonth as string) as protein_cut,
            'starch ' || cast(oday as string) as primary_starch,
            lower(c_mktsegment) as main_starch,
            case when omonth > 6 then 'greens' end as primary_vegetable,
            case when omonth > 3 then 'roots' end as main_vegetable,
            'cuisine ' || c_mktsegment as cuisine,
            lower(o_orderpriority) as dish_type,
            case when omonth = 1 then '' when omonth > 2 then cast(oday as string) end
                as hands_on_time,
            case when omonth > 4 then cast(omonth as string) || '.5' end as hands_on_time_max,
            case when oday <> 3 then cast(omonth as string) end as hands_off_time,
            case when oday = 5 then '' else cast(oday as string) end as hands_off_time_max,
            substring(o_orderpriority, 1, 1) as difficulty,
            lower(c_mktsegment) || ',tag' as tags,
            case omonth when 2 then '' when 3 then 'CALORIE_SMART' when 4 then 'Low Carb,Classics'
                when 5 then 'Family Friendly' when 6 then 'PESCATARIAN' when 7 then 'Quick & Easy'
                when 8 then 'VEGAN' when 9 then 'Veggie,Rapid' when 10 then 'Discovery'
                when 11 then 'unter 650 Kalorien,F,' when 12 then 'plain' end
                as target_preferences,
            case oday when 1 then null when 2 then 'add-ons-x' when 3 then 'x-gc-1'
                when 4 then '1.2-nl-only' when 9 then 'Sides' when 10 then 'addon'
                else 'classic-box' end as target_products,
            case oday when 5 then null when 6 then 'Add-On x' when 7 then 'addon'
                else 'Standard' end as recipe_type,
            o_orderdate as created_at, o_orderdate as updated_at
        from {recipe_orders}""",
    "picklist": """
        select rid as recipe_id, mkt as market,
            case mkt when 'dkse' then case l_returnflag when 'A' then 'SE' when 'N' then 'NO'
                    else 'DK' end
                when 'gb' then case l_returnflag when 'R' then 'GN' else 'GR' end
                when 'benelux' then case l_returnflag when 'R' then 'BE' else 'NL' end
                else upper(mkt) end as segment_name,
            sku_code as code,
            p_name || chr(9) || p_brand || chr(10) as name,
            case when l_linestatus = 'F' then 2 else 4 end as size,
            case when l_linenumber < 7 then l_quantity end as pick_count
        from {recipe_lines}""",
    "box_item": """
        select 'SKU' || cast(p_partkey as string) as code, cast(p_size as double) as boxitem
        from {part} where p_type <> 'SMALL'
        union all
        select 'SKU' || cast(p_partkey as string), cast(p_size as double)
        from {part} where p_brand = 'Brand#13'
        union all
        select 'SKU' || cast(p_partkey as string), 7.0
        from {part} where p_brand = 'Brand#12'""",
    "menu": """
        select mkt as market,
            case mkt when 'dkse' then case l_returnflag when 'A' then 'se' when 'N' then 'no'
                else 'dk' end else mkt end as region_code,
            case when l_tax = 0.0 then 'Green Chef' else 'Main' end as brand_name,
            case when l_discount = 0.1 then 'addon' else 'meal' end as item_type,
            case when l_tax = 0.08 then 'draft' else 'planned' end as status,
            case when mkt = 'ca' then l_linenumber * 20 else l_linenumber end as slot_number,
            ship_week as delivery_week,
            'M' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id,
            rid as recipe_id, ucode as unique_recipe_code
        from {recipe_lines}""",
    "slot_preference": """
        select case when oday < 5 then null
                when oday = 9 then 'Specials' when oday = 10 then 'unlisted'
                when oday = 11 then '' when o_orderstatus = 'F' then 'Balanced, Meat & Veggies'
                when o_orderstatus = 'O' then 'Family, Easy' else 'pescaterian' end
                as recipe_preference,
            case mkt when 'dkse' then case o_orderstatus when 'P' then 'SE' when 'O' then 'NO'
                else 'DK' end when 'benelux' then 'BE' else upper(mkt) end as country,
            case when oday < 30 then 1 + oday % 7 end as slot,
            cast(extract(year from o_orderdate) as string) || '-W' ||
                lpad(cast(extract(quarter from o_orderdate) * 13 - 12 as string), 2, '0')
                as delivery_week,
            cast(extract(year from o_orderdate) as string) || '-Q' ||
                cast(extract(quarter from o_orderdate) as string) as year_quarter
        from {recipe_orders}""",
}


def market_tables(spark: SparkSession, sf_dir: str, *roles: str) -> dict[str, DataFrame]:
    """The roles' frames, all of them when none is named.

    Orders joined with their customers, and order lines joined with those, are
    staged once when several roles are cut from them, with the columns that those
    name. So are the tables of distinct rows that plans read more than once.
    """
    wanted = {role: _TABLES[role] for role in roles or _TABLES}
    frames = {name: table(spark, sf_dir, name) for name in _DRIVER_TABLES}
    lines, orders = (
        [role for role, sql in wanted.items() if "{" + base + "}" in sql]
        for base in ("recipe_lines", "recipe_orders")
    )
    readers = {"recipe_orders": len(orders) + bool(lines), "recipe_lines": len(lines)}
    for name, sql in _BASE.items():
        frames[name] = spark.sql(sql, **frames)
        if readers[name] > 1:
            frames[name] = stage(_named_in(frames[name], name, wanted), name)
            # What the joins have shuffled would lie beside all that the plans shuffle.
            release(spark)
    cut = {role: spark.sql(sql, **frames) for role, sql in wanted.items()}
    return {role: stage(df, role) if role in _READ_OFTEN else df for role, df in cut.items()}


def _named_in(base: DataFrame, name: str, wanted: dict[str, str]) -> DataFrame:
    """The columns of a base that the SQL reading it names, for the wanted roles or another base."""
    lines_wanted = any("{recipe_lines}" in sql for sql in wanted.values())
    texts = [*wanted.values(), *([_BASE["recipe_lines"]] if lines_wanted else [])]
    words = set(re.findall(r"\w+", " ".join(sql for sql in texts if "{" + name + "}" in sql)))
    return base.select(*(column for column in base.columns if column in words))


def market_ctes() -> list[tuple[str, str]]:
    """The same tables as (name, SQL) for a WITH clause over the driver's views."""
    names = {name: name for name in (*_DRIVER_TABLES, *_BASE)}
    return [(name, sql.format(**names)) for name, sql in {**_BASE, **_TABLES}.items()]
