"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.quality import WORD, words
from larder.sources import stage

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = "mix"
#: Cells per level, and levels, of the search for the last document taken.
CELLS, LEVELS = 1024, 3
_HEX = 13
_UNIT = float(1 << 4 * _HEX)
#: The greatest inclusion odds: what is all but certain still has a place of its own.
_ALMOST = 0.999
_ODDS = ("size", "over", "squares")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def _uniform(key: Column, text: Column, seed: str) -> Column:
    """A number between 0 and 1 that depends on the key, the text and the seed only."""
    name = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f"{seed}:"), F.coalesce(text, F.lit("")))
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, _HEX), 16, 10).cast("long").cast("double") + 0.5) / _UNIT


def _odds(size: Column, over: Column, squares: Column) -> Column:
    """The odds that a document is included, as a probability: in proportion to its size.

    With these the words that a sample is expected to hold are the ``over`` words wanted.
    """
    odds = F.least(over * size.cast("double") / squares, F.lit(_ALMOST))
    return F.when(squares > 0, odds).otherwise(0.0)


def _position(u: Column, share: Column) -> Column:
    """The document's place in the order, from 0 to 1: its Pareto quotient q, as q / (1 + q).

    q is the odds of the document's random number over the odds of its inclusion.
    """
    quotient = (u / (1.0 - u)) / (share / (1.0 - share))
    return F.when(share > 0, quotient / (1.0 + quotient)).otherwise(1.0)


def _targets(totals: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Targets of each source from its total: one row per source throughout.

    Sources get shares by weight. With sources in order of cap over weight, the
    capped ones come first, so one running sum finds what resharing converges to.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("long")
    weighed = totals.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    capped = F.col("cap").cast("double") * F.col("left_weight") <= F.col("weight").cast("double") * F.col("left")
    split = weighed.withColumns({"left": left, "left_weight": left_weight}).withColumn("capped", capped)
    cap_sum = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)
    weight_sum = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    rest = F.sum("source_size").over(everything) - cap_sum
    shared = F.col("weight").cast("double") * rest.cast("double") / F.nullif(weight_sum, F.lit(0)).cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(shared)
    some = F.col("source_size") > 0
    whole = F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    over = F.col("target") - F.col("whole").cast("double") * F.col("source_size").cast("double")
    return (
        split.withColumn("target", target)
        .withColumn("whole", whole)
        .withColumn("over", over)
        .select("source", "source_size", "squares", "target", "whole", "over")
    )


def _cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """The targets, with the places up to which each source is taken: below ``low``, and to ``last``.

    Sizes are summed per cell of the order, the cell in which the sum passes the
    wanted words is divided again, and only the documents of the last, tiny cell
    are ordered one by one. No source is ever sorted or gathered as a whole.
    """
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        targets["source"], "size", "over", _position(F.col("u"), _odds(*map(F.col, _ODDS))).alias("place")
    )
    placed = stage(joined.where("place < 1"), "placed")
    cell = stage(
        targets.select("source", F.lit(0.0).alias("low"), F.lit(0).cast("long").alias("below")), "cell"
    )
    source = Window.partitionBy("source").orderBy("part")
    width = 1.0
    for _ in range(LEVELS):
        width /= CELLS
        inside = _inside(placed, cell, width * CELLS)
        part = F.floor((F.col("place") - F.col("low")) / width)
        sums = inside.groupBy("source", "low", "below", "over", part.alias("part")).agg(F.sum("size").alias("words"))
        upto = F.col("below") + F.sum("words").over(source)
        passed = sums.withColumn("upto", upto).where("upto > over")
        first = passed.groupBy("source").agg(F.min_by(F.struct("low", "part", "upto", "words"), "part").alias("c"))
        cell = stage(
            first.select(
                "source",
                (F.col("c.low") + F.col("c.part") * width).alias("low"),
                (F.col("c.upto") - F.col("c.words")).alias("below"),
            ),
            "cell",
        )
    order = Window.partitionBy("source").orderBy("place")
    peers = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    places = _inside(placed, cell, width).groupBy("source", "low", "below", "over", "place").agg(
        F.sum("size").alias("words")
    )
    upto = F.col("below") + F.sum("words").over(peers)
    nearer = F.col("upto") - F.col("over") < F.col("over") - (F.col("upto") - F.col("words"))
    taken = places.withColumn("upto", upto).where((F.col("upto") <= F.col("over")) | nearer)
    last = taken.groupBy("source").agg(F.max("place").alias("last"))
    ends = cell.alias("c").join(last.alias("l"), F.col("c.source").eqNullSafe(F.col("l.source")), "left").select(
        "c.source", "low", "last"
    )
    both = F.col("t.source").eqNullSafe(F.col("e.source"))
    return targets.alias("t").join(ends.alias("e"), both, "left").select("t.*", "e.low", "e.last")


def _inside(placed: DataFrame, cell: DataFrame, width: float) -> DataFrame:
    """The documents of each source's cell."""
    p, c = placed.alias("p"), cell.alias("c")
    inside = (F.col("place") >= F.col("low")) & (F.col("place") < F.col("low") + width)
    return p.join(c, F.col("p.source").eqNullSafe(F.col("c.source"))).where(inside).select("p.*", "low", "below")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """``(row, size, source_size, target, copies)`` for every row of ``docs``.

    ``row`` holds all columns of ``docs``; ``size`` is its number of words. The
    sources, by code point and null last, weigh ``weights`` in turn and share as
    many words as there are; no target is above ``most`` times its source. Each
    document is taken whole as often as its source's target holds the source;
    the remaining words come from an order sample with unequal odds: a document's odds of
    inclusion grow with its size, and documents are taken by Pareto quotient, up to
    the one at which the sum is nearest to what is wanted.
    Reruns agree, as the order depends on keys, texts and seed. Only rows equal in key and text
    have the same place and are taken together. Texts of any length are read whole.
    Null and empty texts have size 0. A source without words has target 0.
    """
    read = docs.select(
        F.col(source).alias("source"), n_words(F.col(text)).alias("size"), _uniform(F.col(key), F.col(text), seed).alias("u")
    )
    sized = stage(read, "sized")
    square = F.col("size").cast("decimal(19,0)") * F.col("size").cast("decimal(19,0)")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(square).cast("double").alias("squares"))
    targets = stage(_targets(stage(totals, "totals"), weights, most), "targets")
    plan = stage(_cuts(sized, targets), "plan")
    rows = docs.select(
        F.struct("*").alias("row"), n_words(F.col(text)).alias("size"), _uniform(F.col(key), F.col(text), seed).alias("u")
    )
    joined = rows.join(plan, F.col(f"row.{source}").eqNullSafe(plan["source"]))
    place = _position(F.col("u"), _odds(*map(F.col, _ODDS)))
    extra = F.when((place < 1) & ((place < F.col("low")) | (place <= F.col("last"))), 1).otherwise(0)
    return joined.select("row", "size", "source_size", "target", (F.col("whole") + extra).alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    chosen = mix(docs, **options).where("copies > 0")
    return chosen.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")


def oracle_sql(table: str = "documents") -> str:
    """The contract's columns, as DuckDB SQL over a table of documents."""
    low, middle, high = WEIGHTS
    return f"""
with sized as (
  select row_number() over () as id, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
    (('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || '{SEED}:' || coalesce(text, '')), 1, {_HEX}))::bigint::double + 0.5::double) / {_UNIT}::double as u
  from {table}),
totals as (
  select source, sum(size)::bigint as source_size, sum(size::hugeint * size)::double as squares from sized group by source),
weighed as (
  select *, {MOST_COPIES} * source_size as cap,
    case (row_number() over (order by source collate "binary" nulls last) - 1) % 3 when 0 then {low} when 1 then {middle} else {high} end as weight
  from totals),
running as (
  select *, sum(source_size) over ()
      - coalesce(sum(cap) over (order by cap / weight, weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as room,
    sum(weight) over ()
      - coalesce(sum(weight) over (order by cap / weight, weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as room_weight
  from weighed),
capped as (select *, cap::double * room_weight::double <= weight::double * room::double as is_capped from running),
targets as (
  select source, source_size, squares, case when is_capped then cap::double else
    weight::double * (sum(source_size) over () - sum(case when is_capped then cap else 0 end) over ())::double
      / sum(case when is_capped then 0 else weight end) over ()::double end as target
  from capped),
shares as (
  select *, case when source_size > 0 then floor(target / source_size::double) else 0 end as whole from targets),
rests as (select *, target - whole * source_size::double as rest from shares),
chances as (
  select s.*, r.source_size, r.target, r.whole, r.rest, least(r.rest * s.size::double / r.squares, {_ALMOST}::double) as share
  from sized s join rests r on s.source is not distinct from r.source),
placed as (
  select *, case when share > 0 then ((u / (1 - u)) / (share / (1 - share))) / (1 + (u / (1 - u)) / (share / (1 - share))) else 1 end as place
  from chances),
summed as (
  select *, sum(size) over (partition by source order by place range between unbounded preceding and current row) as upto,
    sum(size) over (partition by source, place) as own
  from placed)
select doc_id, size, source_size, target,
  (size * (whole + case when place < 1 and (upto <= rest or upto - rest < rest - (upto - own)) then 1 else 0 end))::bigint as taken
from summed"""
