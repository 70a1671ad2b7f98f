"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from millrace.operators import quality as q
from millrace.operators.relations import column_values, deduplicate, differences, union_relations
from millrace.operators.shaping import pivot, unpivot
from millrace.plans.incremental import current_rows, newer_than_target
from millrace.plans.weather import prepare
from millrace.sources.feed import WEATHER
from millrace.workload import REGISTRY
from tests.conftest import plan_of

FOLDER = "/root/testdata/sf0.001"
PYTHON_NODES = r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups"
PAIR_JOINS = r"CartesianProduct|BroadcastNestedLoopJoin"


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_rows_and_no_pair_joins(spark, name):
    plan = plan_of(REGISTRY[name].plan(spark, FOLDER))
    assert not re.search(f"{PYTHON_NODES}|{PAIR_JOINS}", plan)


@pytest.fixture
def lines(spark):
    return spark.read.parquet(f"{FOLDER}/lineitem.parquet")


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{FOLDER}/events.parquet")


def exchanges(plan: str) -> int:
    return len(re.findall(r"\bExchange (?:hash|range|Round|Single)", plan))


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([], WEATHER).write.parquet(f"{tmp_path}/w")
    plan = plan_of(prepare(spark.read.parquet(f"{tmp_path}/w")))
    assert "ReadSchema: struct<location:struct<name:string,region:string,country:string>" in plan
    assert "forecast" not in plan and "PushedFilters: [In(location.country, [Belgium,Netherlands])]" in plan


def test_union_filters_every_input(lines):
    plan = plan_of(union_relations({"a": lines, "b": lines}, include=["l_orderkey"], where="l_quantity > 40"))
    assert plan.count("GreaterThan(l_quantity,40.0)") == 2
    assert plan.count("ReadSchema: struct<l_orderkey:bigint,l_quantity:double>") == 2


def test_deduplicate_prunes_before_the_shuffle(events):
    mixed = plan_of(deduplicate(events, "user_id", ["ts desc", "event_id"]))
    assert "WindowGroupLimit" in mixed.split("Exchange")[1] and exchanges(mixed) == 1
    one_way = plan_of(deduplicate(events, "user_id", "ts desc"))
    assert "partial_max_by" in one_way.split("Exchange")[1] and exchanges(one_way) == 1 and "Window" not in one_way


def test_one_shuffle_operators(lines):
    wide = lines.select("l_orderkey", "l_returnflag", "l_quantity")
    once = {
        "differences": differences(wide, wide.where("l_quantity > 1")),
        "pivot": pivot(wide, "l_orderkey", "l_returnflag", ["A", "N", "R"]),
        "cardinality": q.cardinality_equality(wide, "l_returnflag", wide, "l_returnflag"),
        "not_constant": q.not_constant(wide, "l_returnflag", ["l_orderkey"]),
        "unique": q.unique(wide, "l_orderkey"),
        "column_values": column_values(wide, "l_returnflag", max_records=2),
    }
    assert {name: exchanges(plan_of(df)) for name, df in once.items()} == dict.fromkeys(once, 1)
    assert exchanges(plan_of(unpivot(lines.select("l_orderkey", "l_tax", "l_discount"), exclude=["l_orderkey"]))) == 0


def test_relationship_check_shuffles_distinct_keys_once(spark, lines):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(q.relationships_where(lines, "l_orderkey", orders, "o_orderkey"))
    assert "LeftAnti" in plan and plan.count("partial_count") == 1
    # one per side, none for the join, one to spread the violations
    assert exchanges(plan) == 3


def skewed(spark):
    """A third of the rows belong to one key."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    return spark.range(300_000, numPartitions=8).select(
        key.cast("string").alias("k"), F.lpad(F.col("id").cast("string"), 9, "0").alias("t"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


SHUFFLED = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
SMALL_SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
}


@pytest.mark.parametrize("new_keys", ["drop", "keep"])
def test_hot_key_of_a_load_is_split(spark, new_keys):
    rows = skewed(spark)
    with settings(spark, **SHUFFLED, **SMALL_SKEW):
        fresh = newer_than_target(rows, rows.where("t < '000100000'"), ["k"], "t", new_keys)
        assert "skew=true" in plan_of(fresh, executed=True)
        assert fresh.count() == 200_000


def test_many_rows_with_the_latest_stamp_are_split(spark):
    rows = skewed(spark).withColumn("t", F.when(F.col("k") == "0", "9").otherwise(F.col("t")))
    with settings(spark, **SHUFFLED, **SMALL_SKEW):
        latest = current_rows(rows, ["k"], "t")
        assert "skew=true" in plan_of(latest, executed=True)
        assert latest.where("k = '0'").count() == 100_200


def test_hot_key_of_current_rows_spreads_by_stamp(spark):
    with settings(spark, **SHUFFLED):
        plan = plan_of(current_rows(skewed(spark), ["k"], "t"))
    assert re.search(r"hashpartitioning\(t#\d+, k#", plan)
