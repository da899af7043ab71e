"""One query per operator over the driver's tables, each beside its SQL.

Money is summed as decimals and divided as doubles, so that both engines reach
the same last digit whatever the order of summation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import operators as ops
from larder.sources import stage
from larder.sources.schemas import schema_of
from workload.tables import configure, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = "1998-05-15"
EVENTS_AS_OF = "2024-01-30"


def checked_by(sql: str) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that gives the same rows."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(configure(spark), sf_dir)

        QUERIES[query.__name__] = run
        ORACLES[query.__name__] = sql
        return query

    return register


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


# --- latest rows, means ------------------------------------------------------


@checked_by("""
    select * from orders
    qualify rank() over (partition by o_custkey order by o_orderdate desc) = 1""")
def latest_per_key(spark, sf_dir):
    return ops.latest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate")


@checked_by("""
    select * from customer
    qualify rank() over (partition by c_mktsegment,
        case when right(c_name, 1) in ('1', '2') then right(c_name, 1) else 'X' end
        order by c_nationkey desc) = 1""")
def latest_per_expr_key(spark, sf_dir):
    last = F.right("c_name", F.lit(1))
    suffix = F.when(last.isin("1", "2"), last).otherwise("X")
    customer = table(spark, sf_dir, "customer")
    return ops.latest_per_key(customer, ["c_mktsegment", suffix], "c_nationkey")


@checked_by("""
    select l_partkey,
        cast(sum(cast(l_discount as decimal(10, 2)) * cast(l_quantity as decimal(10, 0))) as double)
            / nullif(sum(l_quantity), 0) as mean_discount,
        cast(sum(cast(l_tax as decimal(10, 2)) * cast(l_quantity as decimal(10, 0))) as double)
            / nullif(sum(l_quantity), 0) as mean_tax
    from lineitem group by l_partkey""")
def weighted_mean(spark, sf_dir):
    quantity = F.col("l_quantity").cast("decimal(10,0)")
    return ops.weighted_mean(
        table(spark, sf_dir, "lineitem"),
        ["l_partkey"],
        {
            "mean_discount": (F.col("l_discount").cast("decimal(10,2)"), quantity),
            "mean_tax": (F.col("l_tax").cast("decimal(10,2)"), quantity),
        },
    )


@checked_by("""
    select l_orderkey,
        cast(sum(cast(l_discount as decimal(10, 2)) * (l_linenumber - 1)) as double)
            / nullif(sum(l_linenumber - 1), 0) as mean_discount
    from lineitem group by l_orderkey""")
def weighted_mean_zero(spark, sf_dir):
    weight = F.col("l_linenumber") - 1
    return ops.weighted_mean(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey"],
        {"mean_discount": (F.col("l_discount").cast("decimal(10,2)"), weight)},
    )


@checked_by("""
    with priced as (
        select *, case when p_size >= 10 and p_brand <> 'Brand#1'
            then cast(p_retailprice as decimal(18, 2)) end as price from part)
    select p_partkey, p_brand, p_type,
        coalesce(cast(price as double),
            cast(sum(price) over (partition by p_brand) as double)
                / nullif(count(price) over (partition by p_brand), 0),
            cast(sum(price) over (partition by p_type) as double)
                / nullif(count(price) over (partition by p_type), 0), 3.4) as price,
        if(price is null, 1, 0) as replaced
    from priced""")
def hierarchical_mean_fill(spark, sf_dir):
    known = (F.col("p_size") >= 10) & (F.col("p_brand") != "Brand#1")
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_type", F.when(known, money("p_retailprice")).alias("price")
    )
    return ops.hierarchical_mean_fill(
        part, {"price": "price"}, ["p_brand", "p_type"], 3.4, {"price": "replaced"}
    )


# --- codes and filters -------------------------------------------------------


@checked_by("""
    select case when n_regionkey in (0, 1) then 'AB' when n_name = 'NATION_7' then 'N7'
        else n_name end as area, count(*) as customers
    from customer join nation on c_nationkey = n_nationkey group by 1""")
def remap_codes(spark, sf_dir):
    nation = ops.remap_codes(
        table(spark, sf_dir, "nation"),
        "area",
        [(F.col("n_regionkey").isin(0, 1), "AB"), (F.col("n_name") == "NATION_7", "N7")],
        F.col("n_name"),
    )
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey").count()
    joined = counts.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("area").agg(F.sum("count").alias("customers"))


@checked_by("""
    select * from orders union all
    select * replace ('X' as o_orderstatus) from orders where o_orderstatus = 'P'""")
def replicate_segment(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return ops.replicate_segment(orders, F.col("o_orderstatus") == "P", {"o_orderstatus": "X"})


@checked_by("""
    select * from orders where (o_orderstatus = 'F' and o_totalprice > 200000)
        or (o_orderstatus = 'O' and lower(o_orderpriority) in ('1-urgent', '2-high'))
        or (o_orderstatus = 'P' and o_totalprice > 100000 and o_orderpriority not like '5%')""")
def rule_filter(spark, sf_dir):
    status, price, priority = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")
    return ops.rule_filter(
        table(spark, sf_dir, "orders"),
        [
            [status == "F", price > 200000],
            [status == "O", F.lower(priority).isin("1-urgent", "2-high")],
            [status == "P", price > 100000, ~priority.startswith("5")],
        ],
    )


@checked_by("""
    select * from part where p_name not like '%bolt%' and p_name not like 'old%'
        and p_type not like 'E%' and p_brand not in ('Brand#3', 'Brand#4')""")
def exclude_patterns(spark, sf_dir):
    return ops.exclude_patterns(
        table(spark, sf_dir, "part"),
        like={"p_name": ["%bolt%", "old%"], "p_type": ["E%"]},
        values={"p_brand": ["Brand#3", "Brand#4"]},
    )


@checked_by("""
    select * from (select * replace (nullif(p_type, 'PROMO') as p_type) from part)
    where p_type not in ('SMALL') and p_name not like '%b_lt%' and p_type not like 'E%'""")
def exclude_null_drop(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return ops.exclude_patterns(
        part.withColumn("p_type", F.nullif("p_type", F.lit("PROMO"))),
        like={"p_name": ["%b_lt%"], "p_type": ["E%"]},
        values={"p_type": ["SMALL"]},
    )


# --- calendar ----------------------------------------------------------------

_CALENDAR = """
    calendar as (select distinct strftime(o_orderdate, '%Y-%m-%d') as day,
        strftime(o_orderdate, '%Y-%m') as label,
        cast(year(o_orderdate) * 4 + quarter(o_orderdate) as int) as period from orders),
    today as (select max(period) as period from calendar where day = '1998-05-15'),
    prices as (select s_nationkey as market, l_partkey as code, l_returnflag as flag,
        strftime(l_shipdate, '%Y-%m') as label, cast(l_extendedprice as decimal(18, 2)) as price
        from lineitem left join supplier on l_suppkey = s_suppkey),
    days as (select p.*, c.period from prices p left join calendar c using (label))"""

_MEAN = "cast(sum(price) as double) / count(price)"


def _calendar(spark, sf_dir):
    """The days that have orders; staged, as it is read several times."""
    day = F.col("o_orderdate")
    days = table(spark, sf_dir, "orders").select(
        F.date_format(day, "yyyy-MM-dd").alias("day"),
        F.date_format(day, "yyyy-MM").alias("label"),
        (F.year(day) * 4 + F.quarter(day)).alias("period"),
    )
    return stage(days.distinct(), "calendar")


def _prices(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("market")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_partkey").alias("code"),
        F.col("l_returnflag").alias("flag"),
        F.date_format("l_shipdate", "yyyy-MM").alias("label"),
        money("l_extendedprice").alias("price"),
    )
    return lines.join(supplier, "l_suppkey", "left")


def _period_mean(spark, sf_dir, calendar, out, always=None):
    return ops.period_average(
        _prices(spark, sf_dir),
        calendar,
        label="label",
        period="period",
        now=ops.calendar_now(calendar, "day", "period", AS_OF),
        keys=["market", "code"],
        value=F.col("price"),
        out=out,
        always=always,
    )


@checked_by(f"with {_CALENDAR} select period + 1 as period from today")
def calendar_now(spark, sf_dir):
    return ops.calendar_now(_calendar(spark, sf_dir), "day", "period", AS_OF, offset=1)


@checked_by(f"""
    with {_CALENDAR} select market, code, {_MEAN} as mean_price from days
    where period = (select period from today) group by all""")
def period_average_strict(spark, sf_dir):
    return _period_mean(spark, sf_dir, _calendar(spark, sf_dir), "mean_price")


@checked_by(f"""
    with {_CALENDAR} select market, code, {_MEAN} as mean_price from days
    where period = (select period from today) or (market in (3, 4) and flag = 'R')
    group by all""")
def period_average_or_scope(spark, sf_dir):
    always = F.col("market").isin(3, 4) & (F.col("flag") == "R")
    return _period_mean(spark, sf_dir, _calendar(spark, sf_dir), "mean_price", always=always)


@checked_by(f"""
    with {_CALENDAR},
        cur as (select market, code, {_MEAN} as current_price from days
            where period = (select period from today) group by all),
        nxt as (select market, code, {_MEAN} as next_price from days
            where period = (select period + 1 from today) group by all)
    select distinct cur.*, next_price from cur
        left join nxt on cur.market = nxt.market and cur.code = nxt.code""")
def period_compare(spark, sf_dir):
    calendar = _calendar(spark, sf_dir)
    return ops.period_compare(
        _prices(spark, sf_dir),
        calendar,
        label="label",
        period="period",
        now=ops.calendar_now(calendar, "day", "period", AS_OF),
        following=ops.calendar_now(calendar, "day", "period", AS_OF, offset=1),
        keys=["market", "code"],
        value=F.col("price"),
        current_out="current_price",
        following_out="next_price",
    )


@checked_by(f"""
    with {_CALENDAR} select market, flag, {_MEAN} as mean_price from prices
    where label between '1997-03' and '1997-09' group by all""")
def range_average(spark, sf_dir):
    return ops.range_average(
        _prices(spark, sf_dir),
        label="label",
        first="1997-03",
        last="1997-09",
        keys=["market", "flag"],
        value=F.col("price"),
        out="mean_price",
    )


@checked_by("""
    with seen as (select *, strftime(ts, '%Y-%m-%d') as day,
            datediff('day', date '2024-01-01', cast(ts as date)) as number from events),
        today as (select max(number) as number from seen where day = '2024-01-30')
    select distinct user_id, event_type, day from seen
    where number >= (select number - 7 from today)""")
def recent_window(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    days = events.select("day", F.date_diff("day", F.lit("2024-01-01")).alias("number"))
    calendar = stage(days.distinct(), "calendar")
    return ops.recent_window(
        events,
        calendar,
        label="day",
        period="number",
        since=ops.calendar_now(calendar, "day", "number", EVENTS_AS_OF, offset=-7),
        columns=["user_id", "event_type", "day"],
    )


@checked_by("""
    with ends as (select min(cast(o_orderdate as date)) as oldest, max(cast(o_orderdate as date)) as newest from orders),
        dated as (select o_custkey, o_orderpriority, cast(o_orderdate as date) as d from orders),
        days as (select distinct d, strftime(d + datediff('day', newest, current_date)::int, '%Y-%m-%d') as day,
            datediff('day', oldest, d) // 91 as period from dated, ends),
        today as (select max(period) as period from days where day = strftime(current_date, '%Y-%m-%d'))
    select distinct o_custkey, o_orderpriority, period::int as period from dated join days using (d)
    where period >= (select period - 1 from today)""")
def recent_window_today(spark, sf_dir):
    """Orders moved in time so that the newest is of today; the session's clock says what is recent."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("d"))
    ends = orders.agg(F.min("d").alias("oldest"), F.max("d").alias("newest"))
    oldest, newest = ends.select("oldest").scalar(), ends.select("newest").scalar()
    moved = F.date_format(F.date_add("d", F.date_diff(F.current_date(), newest)), "yyyy-MM-dd")
    days = orders.select("d").distinct()
    days = stage(days.withColumns({"day": moved, "period": F.floor(F.date_diff(F.col("d"), oldest) / 91).cast("int")}), "days")
    return ops.recent_window(
        orders.join(days.select("d", "period"), "d"),
        days.select("d", "day", F.col("period").alias("number")),
        label="d",
        period="number",
        since=ops.calendar_now(days, "day", "period", offset=-1),
        columns=["o_custkey", "o_orderpriority", "period"],
    )


# --- shape and joins ---------------------------------------------------------


@checked_by("""
    select c_custkey as party, c_name as name, c_mktsegment as segment from customer union all
    select s_suppkey, s_name, null from supplier""")
def stack_all(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as party", "c_name as name", "c_mktsegment as segment"
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_name as name", "s_suppkey as party")
    return ops.stack([customer, supplier])


@checked_by("""
    select o_custkey as party, year(o_orderdate)::int as year from orders union
    select l_suppkey, year(l_shipdate)::int from lineitem""")
def stack_distinct(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as party", "year(o_orderdate) as year"
    )
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey as party", "year(l_shipdate) as year"
    )
    return ops.stack([orders, lines], distinct=True)


@checked_by("""
    select c_custkey as party, c_name as name, c_acctbal as balance, c_mktsegment as segment,
        cast(null as varchar) as contact, 'Customer' as source from customer
    union all
    select s_suppkey, s_name, s_acctbal, null, null, 'Supplier' from supplier""")
def pad_and_stack(spark, sf_dir):
    schema = schema_of(
        "party long, name string, balance double, segment string, contact string, source string"
    )
    customer = table(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_custkey": "party", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"}
    )
    supplier = table(spark, sf_dir, "supplier").withColumnsRenamed(
        {"s_suppkey": "party", "s_name": "name", "s_acctbal": "balance"}
    )
    return ops.stack(
        [
            ops.pad_to_schema(customer, schema, {"source": "Customer"}),
            ops.pad_to_schema(supplier, schema, {"source": "Supplier"}),
        ]
    )


@checked_by("""
    select o_orderkey as id, o_orderstatus as status, upper(o_orderpriority) as priority,
        o_orderdate as created_at from orders""")
def project_rename(spark, sf_dir):
    return ops.project(
        table(spark, sf_dir, "orders"),
        {
            "id": "o_orderkey",
            "status": "o_orderstatus",
            "priority": F.upper("o_orderpriority"),
            "created_at": "o_orderdate",
        },
    )


@checked_by("""
    select distinct c_mktsegment, c_nationkey from customer order by 1, 2""")
def distinct_ordered(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey")
    return ops.distinct_ordered(customer, ["c_mktsegment", "c_nationkey"])


@checked_by("""
    select o_orderkey, o_custkey, c_name, n_name, r_name, mean_discount
    from orders left join customer on o_custkey = c_custkey
        left join nation on c_nationkey = n_nationkey
        left join region on n_regionkey = r_regionkey
        left join (select l_orderkey,
            cast(sum(cast(l_discount as decimal(10, 2)) * cast(l_quantity as decimal(10, 0)))
                as double) / nullif(sum(l_quantity), 0) as mean_discount
            from lineitem group by 1) on l_orderkey = o_orderkey""")
def enrich_left(spark, sf_dir):
    discounts = ops.weighted_mean(
        table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"),
        ["o_orderkey"],
        {
            "mean_discount": (
                F.col("l_discount").cast("decimal(10,2)"),
                F.col("l_quantity").cast("decimal(10,0)"),
            )
        },
    )
    joined = ops.enrich(
        table(spark, sf_dir, "orders"),
        [
            (discounts, "o_orderkey", "left"),
            (table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left"),
            (table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"),
            (table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"),
        ],
    )
    return joined.select("o_orderkey", "o_custkey", "c_name", "n_name", "r_name", "mean_discount")


@checked_by("""
    select c_custkey, c_name, o_orderkey, l_linenumber, l_partkey
    from customer left join orders on c_custkey = o_custkey
        left join lineitem on o_orderkey = l_orderkey""")
def enrich_fanout(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey as c_custkey")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as o_orderkey", "l_linenumber", "l_partkey"
    )
    joined = ops.enrich(
        table(spark, sf_dir, "customer"),
        [
            (orders, "c_custkey", "left_many"),
            (lines, "o_orderkey", "left_many"),
        ],
    )
    return joined.select("c_custkey", "c_name", "o_orderkey", "l_linenumber", "l_partkey")


# --- bill of materials -------------------------------------------------------

_LINES = """
    lines as (select l_orderkey, 'P' || cast(l_partkey as varchar) as code, p_name as name,
        l_linenumber, cast(l_quantity as decimal(10, 0)) as quantity,
        case p_type when 'SMALL' then 0 when 'PROMO' then null
            else cast(p_retailprice as decimal(18, 2)) end as price
        from lineitem join part on l_partkey = p_partkey),
    items as (select l_orderkey, code, name,
        case when price is null or price = 0 then code end as missing,
        sum(case when l_linenumber <= 2 then quantity * price else 0 end) as cost
        from lines group by all)"""


def _order_lines(spark, sf_dir):
    price = (
        F.when(F.col("p_type") == "SMALL", F.lit(0).cast("decimal(18,2)"))
        .when(F.col("p_type") == "PROMO", None)
        .otherwise(money("p_retailprice"))
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name"), price.alias("price")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("code"),
        F.col("l_quantity").cast("decimal(10,0)").alias("quantity"),
    )
    return lines.join(part, "l_partkey")


def _order_rollup(spark, sf_dir):
    counted = F.when(F.col("l_linenumber") <= 2, F.col("quantity") * F.col("price"))
    paid = F.when(F.col("l_linenumber") > 2, F.lit(0)).otherwise(counted)
    return ops.bom_rollup(
        _order_lines(spark, sf_dir),
        parents=["l_orderkey"],
        item="code",
        name="name",
        price="price",
        costs={"cost": paid},
    )


@checked_by(f"""
    with {_LINES} select l_orderkey,
        string_agg(code, ' | ' order by code, name, missing nulls first) as items,
        string_agg(name, ' | ' order by code, name, missing nulls first) as names,
        cast(count(distinct code) as bigint) as item_count, cast(sum(cost) as double) as cost
    from items group by l_orderkey""")
def bom_rollup(spark, sf_dir):
    return _order_rollup(spark, sf_dir).select(
        "l_orderkey", "items", "names", "item_count", F.col("cost").cast("double").alias("cost")
    )


@checked_by(f"""
    with {_LINES} select l_orderkey,
        coalesce(string_agg(missing, ' | ' order by missing), '') as missing_prices
    from items group by l_orderkey""")
def bom_missing(spark, sf_dir):
    return _order_rollup(spark, sf_dir).select("l_orderkey", "missing_prices")


# --- cleaning and filling ----------------------------------------------------


@checked_by("""
    select doc_id, lang, replace(replace(text, chr(9), ''), chr(10), '') as text from documents""")
def clean_text(spark, sf_dir):
    return ops.clean_columns(table(spark, sf_dir, "documents"), ["text"]).select(
        "doc_id", "lang", "text"
    )


@checked_by("""
    select c_custkey, case when c_acctbal > 0 then c_acctbal else 999 end as c_acctbal
    from customer""")
def sentinel_fill(spark, sf_dir):
    balance = F.col("c_acctbal")
    known = F.when(balance > 0, balance).when(balance < -500, 0.0)
    customer = table(spark, sf_dir, "customer").select("c_custkey", known.alias("c_acctbal"))
    return ops.sentinel_fill(customer, "c_acctbal", 999.0, [0])


_MINUTES = {
    "on_time": "case left(o_orderpriority, 1) when '1' then null when '2' then '' "
    "when '3' then 'soon' else left(o_orderpriority, 1) || '.5' end",
    "off_time": "case when o_orderstatus = 'P' then '' else cast(month(o_orderdate) as {}) end",
}


@checked_by(f"""
    select o_orderkey, cast(
            case when on_time is null or on_time = '' then 99 else try_cast(on_time as float) end
            + case when off_time is null or off_time = '' then 99
                else try_cast(off_time as float) end as float) as total_time
    from (select o_orderkey, {_MINUTES["on_time"]} as on_time,
        {_MINUTES["off_time"].format("varchar")} as off_time from orders)""")
def duration_total(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(_MINUTES["on_time"]).alias("on_time"),
        F.expr(_MINUTES["off_time"].format("string")).alias("off_time"),
    )
    return ops.duration_total(orders, ["on_time", "off_time"], "total_time").select(
        "o_orderkey", "total_time"
    )


# --- tags --------------------------------------------------------------------


@checked_by("""
    select doc_id, lang,
        case when lower(text) like '%the%' or lower(text) like '%les%' then 'Common' end as common,
        case when lower(text) like '%q_e%' or lang in ('de', 'es') then 'Que' end as que,
        case when lower(text) like '%license%'
            or (lang = 'fr' and lower(text) like '%.') then 'Legal' end as legal
    from documents""")
def tag_by_rules(spark, sf_dir):
    rules = [
        ops.TagRule("common", "Common", ("%the%", "%LES%")),
        ops.TagRule("que", "Que", ("%Q_E%",), members={"lang": ("de", "es")}),
        ops.TagRule("legal", "Legal", ("%License%",), local=(("lang", "fr", "%."),)),
    ]
    tagged = ops.tag_by_rules(table(spark, sf_dir, "documents"), "text", rules)
    return tagged.select("doc_id", "lang", "common", "que", "legal")


_PART_NAMES = """
    names as (select p_partkey, p_brand, case p_type when 'PROMO' then null when 'SMALL' then ''
        else p_name end as name from part),
    tagged as (select *, case when lower(name) like '%ring%' then 'Ring' end as ring,
        case when lower(name) like 'old%' or lower(name) like '%g_zmo%' then 'Old' end as old,
        case when lower(name) like '%nothing%' or name is null or name = '' then 'Plain' end
            as plain from names)"""

_PART_RULES = [
    ops.TagRule("ring", "Ring", ("%ring%",)),
    ops.TagRule("old", "Old", ("old%", "%g_zmo%")),
    ops.TagRule("plain", "Plain", ("%nothing%",), blank=True),
]
_PART_TAGS = [rule.column for rule in _PART_RULES]


def _tagged_parts(spark, sf_dir):
    name = (
        F.when(F.col("p_type") == "PROMO", None)
        .when(F.col("p_type") == "SMALL", "")
        .otherwise(F.col("p_name"))
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", name.alias("name"))
    return ops.tag_by_rules(part, "name", _PART_RULES)


@checked_by(f"with {_PART_NAMES} select * from tagged")
def tag_null_arm(spark, sf_dir):
    return _tagged_parts(spark, sf_dir)


@checked_by(f"""
    with {_PART_NAMES} select *,
        if(name is null or name = '', 'EMPTY_PREFERENCE', 'AT_LEAST_1') as checked,
        if(name is null or name = '', 'EMPTY_PREFERENCE', concat_ws(', ', ring, old, plain)) as tags
    from tagged""")
def tag_list(spark, sf_dir):
    return ops.tag_list(_tagged_parts(spark, sf_dir), "name", _PART_TAGS, "tags", "checked")


@checked_by(f"""
    with {_PART_NAMES}
    select distinct p_brand, ring, old, plain, 'Ring' as tag from tagged where ring is not null
    union select p_brand, ring, old, plain, 'Old' from tagged where old is not null
    union select p_brand, ring, old, plain, 'Plain' from tagged where plain is not null
    union select p_brand, ring, old, plain, 'EMPTY_PREFERENCE' from tagged
        where ring is null and old is null and plain is null""")
def explode_tags(spark, sf_dir):
    tagged = _tagged_parts(spark, sf_dir).select("p_brand", *_PART_TAGS)
    return ops.explode_tags(tagged, _PART_TAGS, "tag")
