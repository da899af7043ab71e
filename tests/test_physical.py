"""Physical plans: what is scanned, pushed, shuffled and split."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from larder import operators as ops
from larder.operators.shape import ranged
from workload import market_queries, operator_queries
from workload.tables import table

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan after adaptive execution has run the query."""
    df.collect()
    return plan(df).split("Initial Plan")[0]


@contextlib.contextmanager
def settings(spark, **values):
    values = {f"spark.sql.{name.replace('__', '.')}": value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", sorted(operator_queries.QUERIES))
def test_no_cross_join_python_or_forced_broadcast(spark, name):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(operator_queries.QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "BroadcastHashJoin", "Python", "Pandas"):
        assert unwanted not in text


# Scans of the driver's tables and of staged frames in the last job of each query.
MARKET_SCANS = {
    "market_scores": 4,
    "market_usage": 4,
    "market_nutrition": 6,
    "market_sku_prices": 6,
    "market_ready_recipes": 4,
    "market_picklist_costs": 14,
    "market_pool_recipes": 8,
    "market_menu_window": 7,
    "market_demand_recipes": 9,
    "recipe_pool": 24,
}


@pytest.mark.parametrize("name", sorted(MARKET_SCANS))
def test_market_plans(spark, name):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(market_queries.QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "BroadcastHashJoin", "Python", "Pandas"):
        assert unwanted not in text
    assert text.count("Scan parquet") <= MARKET_SCANS[name]
    for unread in ("l_suppkey", "l_comment", "o_comment", "c_address"):
        assert unread not in "".join(part.split(">")[0] for part in text.split("ReadSchema: ")[1:])


@pytest.mark.parametrize("name", ["explode_tags", "tag_list", "replicate_segment", "weighted_mean"])
def test_one_scan(spark, name):
    assert plan(operator_queries.QUERIES[name](spark, SF_DIR)).count("Scan parquet") == 1


def test_latest_needs_no_window(spark):
    text = plan(operator_queries.latest_per_key(spark, SF_DIR))
    assert "Window" not in text
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_columns_are_pruned_and_filters_pushed(spark):
    text = plan(operator_queries.weighted_mean_zero(spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_discount:double>" in text
    kept = ops.exclude_patterns(table(spark, SF_DIR, "part"), like={"p_name": ["%bolt%", "old%"]})
    assert "Not(StringContains(p_name,bolt))" in plan(kept)
    assert "Not(StringStartsWith(p_name,old))" in plan(kept)


@pytest.mark.parametrize("hot_side", ["fact", "many"])
def test_hot_keys_of_a_fan_out_join_are_split(spark, tmp_path, hot_side):
    """A key with a third of the rows on either side is read by several tasks."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k")
    hot = spark.range(0, 60000, 1, 8).select(key, F.sha2(F.col("id").cast("string"), 256).alias("x"))
    cold = spark.range(0, 200, 1, 8).select(F.col("id").alias("k"), F.col("id").alias("y"))
    hot.write.parquet(f"{tmp_path}/hot")
    cold.write.parquet(f"{tmp_path}/cold")
    hot, cold = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("hot", "cold"))
    fact, many = (hot, cold) if hot_side == "fact" else (cold, hot)
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="64k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="200k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        files__maxPartitionBytes="256k",
    ):
        joined = ops.fan_out_join(fact, many, ["k"])
        expected = fact.join(many, "k", "left").count()
        assert "SortMergeJoin(skew=true)" in final_plan(joined)
        assert len(joined.collect()) == expected


def test_chained_fan_out_joins_read_linearly(spark, tmp_path):
    for name in ("fact", "many"):
        spark.range(5).select(F.col("id").alias("k"), F.col("id").alias(name)).write.parquet(f"{tmp_path}/{name}")
    fact, many = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("fact", "many"))
    scans = []
    for n in range(1, 5):
        joined = ops.enrich(fact, [(many.withColumnRenamed("many", f"m{i}"), "k", "left_many") for i in range(n)])
        scans.append(plan(joined).count("Scan parquet"))
    assert scans == [3, 5, 7, 9]


def test_period_compare_reads_its_facts_once(spark):
    text = plan(operator_queries.period_compare(spark, SF_DIR))
    assert text.split("Subquery")[0].count("lineitem.parquet") == 1


def test_sort_spreads_a_hot_key(spark):
    df = spark.range(0, 4000, 1, 4).select(F.lit("GB").alias("k"), "id")
    with settings(spark, adaptive__coalescePartitions__enabled="false"):
        sizes = ops.distinct_ordered(df, ["k"]).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1


def test_the_pool_is_made_distinct_and_sorted_by_one_shuffle(spark):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(market_queries.recipe_pool(spark, SF_DIR)).split("Union")[0]
    assert text.count("Exchange") == text.count("Exchange rangepartitioning") == 1


def test_ranged_rows_are_distinct_in_order_and_spread(spark):
    key = F.when(F.col("id") >= 0, "GB").alias("k")
    df = spark.range(0, 4000, 1, 4).select(key, (F.col("id") % 1000).alias("x"))
    with settings(spark, adaptive__coalescePartitions__enabled="false"):
        dealt = ranged(df, ["k"], "tie").distinct().orderBy("k", "tie")
        assert plan(dealt).count("Exchange") == 1
        got = [(r.k, r.tie, r.x) for r in dealt.collect()]
        assert dealt.groupBy(F.spark_partition_id()).count().count() > 1
    assert got == sorted(got) and sorted(x for _, _, x in got) == list(range(1000))
