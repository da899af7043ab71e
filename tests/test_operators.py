"""Semantics of the operators on small frames, and equality with plain forms."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from larder import operators as ops
from larder.sources.schemas import schema_of


# --- latest rows and means ---


def test_latest_keeps_ties_null_keys_and_all_null_orders(frame):
    df = frame(
        "k string, w string, v int",
        ("a", "2024-W01", 1),
        ("a", "2024-W02", 2),
        ("a", "2024-W02", 3),
        ("a", None, 4),
        ("b", None, 5),
        ("b", None, 6),
        (None, "2024-W01", 7),
        (None, "2023-W52", 8),
    )
    assert [r[2] for r in rows(ops.latest_per_key(df, ["k"], "w").orderBy("v"))] == [2, 3, 5, 6, 7]


def test_latest_by_expression_key(frame):
    df = frame("c string, w int", ("xFR", 1), ("yFR", 2), ("xZZ", 5), ("yAA", 4))
    suffix = F.right("c", F.lit(2))
    out = ops.latest_per_key(df, [F.when(suffix == "FR", suffix).otherwise("X")], "w")
    assert rows(out) == [("xZZ", 5), ("yFR", 2)]


def test_latest_equals_window_form(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]), i) for i in range(200)]
    df = spark.createDataFrame(data, "k string, o int, i int")
    window = Window.partitionBy("k").orderBy(F.desc("o"))
    plain = df.withColumn("r", F.dense_rank().over(window)).filter("r = 1").drop("r")
    assert rows(ops.latest_per_key(df, ["k"], "o")) == rows(plain)


def test_weighted_mean(frame):
    df = frame(
        "k string, x double, w int",
        ("a", 1.0, 1),
        ("a", 4.0, 2),
        ("b", 5.0, 0),
        ("c", None, 3),
        ("c", 2.0, 1),
    )
    out = ops.weighted_mean(df, ["k"], {"m": (F.col("x"), F.col("w"))})
    assert rows(out) == [("a", 3.0), ("b", None), ("c", 0.5)]


def _window_fill(df, column, groups, default):
    means = [F.avg(column).over(Window.partitionBy(g)) for g in groups]
    return df.withColumn(column, F.coalesce(column, *means, F.lit(default)))


def test_hierarchical_fill_equals_window_form(spark):
    rng = random.Random(2)
    data = [
        (i, rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), rng.choice([None, 1.0, 2.0, 4.0]))
        for i in range(60)
    ]
    data = [(i, p, m, None if p == "c" or (p is None and m == "y") else v) for i, p, m, v in data]
    data += [(100, "d", "z", None)]
    df = spark.createDataFrame(data, "i int, p string, m string, v double")
    out = ops.hierarchical_mean_fill(df, {"v": "v"}, ["p", "m"], 3.4, {"v": "missing"})
    plain = {r.i: r.v for r in _window_fill(df, "v", ["p", "m"], 3.4).collect()}
    for r in out.collect():
        assert r.v == pytest.approx(plain[r.i])
        assert r.missing == (data[[d[0] for d in data].index(r.i)][3] is None)
    assert plain[100] == 3.4


def test_hierarchical_fill_weights_count_as_rows(frame):
    df = frame("g string, v double, n int", ("a", 1.0, 3), ("a", 5.0, 1), ("a", None, 7))
    out = ops.hierarchical_mean_fill(df, {"v": "v"}, ["g"], 0.0, weight=F.col("n"))
    assert sorted(r.v for r in out.collect()) == [1.0, 2.0, 5.0]


# --- codes, filters, shape ---


def test_remap_sees_input_columns(frame):
    df = frame("m string, r string", ("dk", "no"), ("gb", "x"), (None, "no"))
    out = ops.remap_codes(df, "m", [(F.col("r") == "no", "no"), (F.col("m") == "no", "?")], F.col("m"))
    assert rows(out) == [("gb", "x"), ("no", "no"), ("no", "no")]


def test_rules_bind_and_before_or(frame):
    df = frame("a int, b int", (1, 0), (1, 1), (0, 1), (None, 1))
    out = ops.rule_filter(df, [[F.col("a") == 1, F.col("b") == 0], [F.col("b") == 1, F.col("a") == 0]])
    assert rows(out) == [(0, 1), (1, 0)]
    assert rows(ops.rule_filter(df, [])) == []


def test_exclusions_drop_nulls(frame):
    df = frame("t string, u string", ("addon x", "a"), ("Addon", "a"), (None, "a"), ("ok", None), ("ok", "z"))
    out = ops.exclude_patterns(df, like={"t": ["addon%"]}, values={"u": ["z"]})
    assert rows(out) == [("Addon", "a")]


def test_replicate_equals_union(frame):
    df = frame("m string, v int", ("dkse", 1), ("gb", 2), (None, 3))
    out = ops.replicate_segment(df, F.col("m") == "dkse", {"m": "no"})
    assert rows(out) == rows(df.union(df.filter("m = 'dkse'").withColumn("m", F.lit("no"))))


def test_stack_types_missing_columns(frame):
    out = ops.stack([frame("a int, b string", (1, "x")), frame("b string", ("y",), ("y",))])
    assert out.dtypes == [("a", "int"), ("b", "string")]
    assert rows(out) == [(1, "x"), (None, "y"), (None, "y")]
    assert ops.stack([out, out], distinct=True).count() == 2


def test_pad_to_schema(frame):
    schema = schema_of("x double, y string, s string")
    out = ops.pad_to_schema(frame("z int, x int", (1, 2)), schema, {"s": "Demand"})
    assert out.schema.simpleString() == "struct<x:double,y:string,s:string>"
    assert rows(out) == [(2.0, None, "Demand")]


def test_project_and_clean(frame):
    df = frame("a string, b int", ("x\ty\n", 1))
    assert rows(ops.project(ops.clean_columns(df, ["a"]), {"t": "a", "n": F.col("b") + 1})) == [("xy", 2)]


def test_distinct_ordered(frame):
    df = frame("k int, v string", (2, "b"), (1, "z"), (2, "b"), (1, "a"))
    out = [r.k for r in ops.distinct_ordered(df, ["k"]).collect()]
    assert out == [1, 1, 2]


def test_sentinel_and_duration(frame):
    df = frame("x double, a string, b string", (0.0, "", "5"), (None, None, ""), (7.0, "1.5", "2"), (1.0, "?", "2"))
    out = ops.duration_total(ops.sentinel_fill(df, "x", 999.0, [0]), ["a", "b"], "t")
    assert rows(out.select("x", "t")) == [(1.0, None), (7.0, 3.5), (999.0, 104.0), (999.0, 198.0)]


# --- joins ---


def test_enrich_keeps_fan_out(frame):
    fact = frame("k int, v string", (1, "a"), (2, "b"))
    many = frame("k int, w string", (1, "x"), (1, "y"))
    assert rows(ops.enrich(fact, [(many, "k", "left")])) == [(1, "a", "x"), (1, "a", "y"), (2, "b", None)]
    assert rows(ops.enrich(fact, [(many, "k", "inner")])) == [(1, "a", "x"), (1, "a", "y")]


@pytest.mark.parametrize("told", [False, True])
def test_fan_out_join_equals_left_join(spark, told):
    rng = random.Random(3)
    pick = lambda n: [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "a", "b"]), i) for i in range(n)]
    fact = spark.createDataFrame(pick(40), "k int, m string, v int")
    many = spark.createDataFrame([r for r in pick(40) if r[0] != 4], "k int, m string, w int")
    has = {(r.k, r.m) for r in many.collect()}
    present = F.concat_ws("", "k", "m").isin(*(f"{k}{m}" for k, m in has if k and m)) if told else None
    out = ops.fan_out_join(fact, many, ["k", "m"], present)
    plain = fact.join(many, ["k", "m"], "left").select(*out.columns)
    assert rows(out) == rows(plain)
    assert out.columns == ["k", "m", "v", "w"]


def test_left_many_takes_columns_only(frame):
    fact = frame("k int", (1,))
    with pytest.raises(TypeError, match="left_many"):
        ops.enrich(fact, [(frame("j int", (1,)), F.col("k") == F.col("j"), "left_many")])


# --- calendar ---

CALENDAR = [
    ("2024-03-29", "W13", 5, 1),
    ("2024-03-30", "W13", 5, 1),
    ("2024-04-01", "W13", 5, 2),
    ("2024-04-05", "W14", 6, 2),
    ("2024-07-01", "W27", 19, 3),
]


@pytest.fixture
def calendar(frame):
    return frame("day string, label string, week int, quarter int", *CALENDAR)


def test_calendar_now(calendar, spark):
    assert rows(ops.calendar_now(calendar, "day", "quarter", "2024-04-05", 1)) == [(3,)]
    assert rows(ops.calendar_now(calendar, "day", "quarter", "1999-01-01")) == [(None,)]
    today = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd").alias("day"))
    assert rows(ops.calendar_now(today.withColumn("q", F.lit(7)), "day", "q")) == [(7,)]


def test_label_days_counts_a_week_in_two_quarters(calendar):
    out = ops.label_days(calendar, "label", {"second": F.col("quarter") == 2})
    assert rows(out) == [("W13", 3, 1), ("W14", 1, 1), ("W27", 1, 0)]


@pytest.mark.parametrize("as_of", ["2024-04-05", "1999-01-01"])
@pytest.mark.parametrize("scoped", [False, True])
def test_period_average_equals_day_grain(spark, calendar, as_of, scoped):
    rng = random.Random(4)
    data = [
        (rng.choice(["a", "b", None]), rng.choice(["W13", "W14", "W27", "W99", None]), rng.choice([None, 1.0, 2.0, 8.0]), rng.choice([0, 1, None]))
        for _ in range(150)
    ]
    facts = spark.createDataFrame(data, "k string, label string, x double, s int")
    now = ops.calendar_now(calendar, "day", "quarter", as_of)
    scope = F.col("s") == 1
    out = ops.period_average(
        facts, calendar, label="label", period="quarter", now=now, keys=["k"],
        value=F.col("x"), out="m", always=scope if scoped else None,
    )
    kept = F.col("quarter") == now.scalar()
    plain = (
        facts.join(calendar, "label", "left")
        .filter(kept | scope if scoped else kept)
        .groupBy("k").agg(F.avg("x").alias("m"))
    )
    assert rows(out.select("k", F.round("m", 9))) == rows(plain.select("k", F.round("m", 9)))


def test_range_average_takes_both_ends(frame):
    df = frame("w string, x double", ("2023-W29", 9.0), ("2023-W30", 1.0), ("2023-W43", 3.0), ("2023-W44", 9.0))
    out = ops.range_average(df.withColumn("k", F.lit(1)), label="w", first="2023-W30", last="2023-W43", keys=["k"], value=F.col("x"), out="m")
    assert rows(out) == [(1, 2.0)]


def test_period_compare_keeps_current_without_next(frame, calendar):
    facts = frame(
        "k int, label string, v double",
        (1, "W13", 2.0),
        (1, "W14", 5.0),
        (2, "W13", 4.0),
        (2, "W13", None),
        (3, "W27", 9.0),
        (4, "W99", 9.0),
        (None, "W13", 1.0),
        (None, "W27", 1.0),
    )
    out = ops.period_compare(
        facts,
        calendar,
        label="label",
        period="quarter",
        now=ops.calendar_now(calendar, "day", "quarter", "2024-04-01"),
        following=ops.calendar_now(calendar, "day", "quarter", "2024-04-01", offset=1),
        keys=["k"],
        value=F.col("v"),
        current_out="c",
        following_out="n",
    )
    assert rows(out) == sorted([(1, 3.5, None), (2, 4.0, None), (None, 1.0, None)], key=repr)


def test_recent_window_has_no_upper_bound(frame, calendar):
    df = frame("label string, v int", ("W13", 1), ("W14", 2), ("W14", 2), ("W27", 3), ("W99", 4))
    since = ops.calendar_now(calendar, "day", "week", "2024-07-01", offset=-13)
    out = ops.recent_window(df, calendar, label="label", period="week", since=since, columns=["label", "v"])
    assert rows(out) == [("W14", 2), ("W27", 3)]


# --- bill of materials ---


def test_bom_rollup(frame):
    df = frame(
        "r string, c string, n string, price double, units double",
        ("r1", "B", "bean", 2.0, 1.0),
        ("r1", "B", "bean", 2.0, 2.0),
        ("r1", "A", "apple", None, 1.0),
        ("r1", "C", "corn", 0.0, 1.0),
        ("r2", "A", "apple", None, 1.0),
    )
    out = ops.bom_rollup(
        df, parents=["r"], item="c", name="n", price="price",
        costs={"cost": F.col("price") * F.col("units")},
    )
    assert rows(out) == [
        ("r1", "A | B | C", "apple | bean | corn", 3, 6.0, "A | C"),
        ("r2", "A", "apple", 1, None, "A"),
    ]


def test_bom_lists_an_item_per_name_but_counts_it_once(frame):
    df = frame("r string, c string, n string, price double", ("r", "A", "old", 1.0), ("r", "A", "new", 1.0), ("r", None, None, 1.0))
    out = ops.bom_rollup(df, parents=["r"], item="c", name="n", price="price", costs={"cost": F.col("price")})
    assert rows(out) == [("r", "A | A", "new | old", 1, 3.0, "")]


# --- tags ---

RULES = [
    ops.TagRule("smart", "Smart", ("%CALORIE_SMART%", "%cs%")),
    ops.TagRule("classic", "Classic", ("%cl%",), blank=True),
    ops.TagRule("fish", "Fish", ("%fish%",), members={"protein": ("Salmon",)}),
    ops.TagRule("family", "Family", ("%family%",), local=(("country", "BNL", "%F,"),)),
]


def _tagged(frame, *data):
    return ops.tag_by_rules(frame("t string, protein string, country string", *data), "t", RULES)


@pytest.mark.parametrize(
    ("text", "protein", "country", "expected"),
    [
        ("calorie smart", None, None, {"smart"}),
        ("Classics", None, None, {"smart", "classic"}),
        (None, None, None, {"classic"}),
        ("", "Salmon", None, {"classic", "fish"}),
        ("F", None, "BNL", set()),
        ("a,f,", None, "BNL", {"family"}),
        ("a,f,", None, "BENELUX", set()),
        ("FAMILY fish", "Beef", None, {"family", "fish"}),
    ],
)
def test_tag_rules(frame, text, protein, country, expected):
    row = _tagged(frame, (text, protein, country)).first()
    assert {r.column for r in RULES if row[r.column] == r.label} == expected
    assert {r.column for r in RULES if row[r.column] is not None} == expected


def test_tag_list(frame):
    tagged = _tagged(frame, ("family classics", None, None), ("zzz", None, None), ("", None, None), (None, None, None))
    out = ops.tag_list(tagged, "t", [r.column for r in RULES], "tags", "checked")
    assert rows(out.select("checked", "tags")) == [
        ("AT_LEAST_1", ""),
        ("AT_LEAST_1", "Smart, Classic, Family"),
        ("EMPTY_PREFERENCE", "EMPTY_PREFERENCE"),
        ("EMPTY_PREFERENCE", "EMPTY_PREFERENCE"),
    ]


def test_explode_equals_union_of_tags(spark):
    rng = random.Random(5)
    data = [tuple(rng.choice([None, label]) for label in "ABC") + (rng.randrange(3),) for _ in range(60)]
    df = spark.createDataFrame(data, "a string, b string, c string, v int")
    out = ops.explode_tags(df, ["a", "b", "c"], "tag")
    union = df.filter("coalesce(a, b, c) is null").withColumn("tag", F.lit("EMPTY_PREFERENCE"))
    for column, label in zip("abc", "ABC"):
        union = union.union(df.filter(F.col(column).isNotNull()).withColumn("tag", F.lit(label)))
    assert rows(out) == rows(union.distinct())
