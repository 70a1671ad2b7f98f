"""The chunks must give what one window over the whole group gives."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import Window, functions as F

from millrace.operators import neighbours
from millrace.operators.neighbours import COPIES, NEXT, with_next
from millrace.operators.quality import mutually_exclusive_ranges, sequential_values
from millrace.operators.relations import repeat_rows
from tests.conftest import bag, plan_of


def followers(data, group: int):
    """Every row with its successor, by sorting each group; NULL sorts last."""
    groups: dict = {}
    for row in data:
        groups.setdefault(row[:group], []).append(row[group:])
    out = Counter()
    for key, members in groups.items():
        members.sort(key=lambda m: [(v is None, v if v is not None else 0) for v in m])
        for here, after in zip(members, members[1:] + [None], strict=True):
            out[(*key, *here, after)] += 1
    return out


def single_rows(df):
    return repeat_rows(df, COPIES) if COPIES in df.columns else df


def skewed_rows(seed: int, n: int = 400):
    """A third of the rows in one group, a third of them with one value, some NULLs."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        g = "hot" if draw.random() < 0.34 else draw.choice(["a", "b", None, "zz"])
        x = 7 if draw.random() < 0.34 else draw.choice([None, *range(60)])
        rows.append((g, x, draw.choice([None, 1, 2])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_next_row(spark, seed):
    data = skewed_rows(seed)
    df = spark.createDataFrame(data, "g string, x int, y int")
    found = single_rows(with_next(df, ["g"], ["x", "y"]))
    assert Counter((r.g, r.x, r.y, None if r[NEXT] is None else tuple(r[NEXT])) for r in found.collect()) == followers(data, 1)


def test_next_row_without_groups(spark):
    data = [(x,) for _, x, _ in skewed_rows(9)]
    df = spark.createDataFrame(data, "`odd name.x` int")
    found = single_rows(with_next(df, [], ["odd name.x"]))
    assert Counter((r[0], None if r[NEXT] is None else tuple(r[NEXT])) for r in found.collect()) == followers(data, 0)


@pytest.mark.parametrize("kind", ["int", "double", "string", "date", "timestamp", "timestamp_ntz", "decimal(9,2)", "array<int>"])
def test_cuts_of_any_type_with_few_conditions(spark, monkeypatch, kind):
    """More cuts than conditions on literals, so that the search in the array goes on; NULLs and quotes among the values."""
    monkeypatch.setattr(neighbours, "TREE_CUTS", 3)
    base = spark.range(400).select(F.pmod(F.hash("id"), F.lit(150)).alias("n"))
    value = {"date": "date_add(date'2024-01-01', n)", "timestamp": "timestamp_seconds(n * 3601)", "array<int>": "array(n % 7, n)",
             "timestamp_ntz": "cast(timestamp_seconds(n * 3601) as timestamp_ntz)",
             "string": "concat(n, ' it\\'s \\\\ x')", "double": "if(n = 3, double('NaN'), n / 7)"}.get(kind, f"cast(n as {kind})")
    df = base.selectExpr(f"if(n % 10 = 0, null, {value}) as x")
    window = Window.orderBy(F.col("x").asc_nulls_last())
    expected = bag(df.select(F.col("x").cast("string").alias("x"), F.lead(F.struct("x")).over(window).cast("string").alias("y")))
    found = single_rows(with_next(df, [], ["x"]))
    assert bag(found.select(F.col("x").cast("string").alias("x"), F.col(NEXT).cast("string").alias("y"))) == expected


def test_empty_table(spark):
    df = spark.createDataFrame([], "g string, x int")
    assert with_next(df, ["g"], ["x"]).isEmpty()
    assert sequential_values(df, "x").isEmpty()


def test_no_task_gets_a_whole_group(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("g"), F.col("id").alias("x"))
    chunked = with_next(df, ["g"], ["x"])
    plan = chunked._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(__chunk" in plan and "windowspecdefinition(g" not in plan
    assert chunked.where(F.col(f"{NEXT}.x") == F.col("x") + 1).count() == 9_999


def test_groups_within_their_share_cost_one_exchange(spark):
    df = spark.range(10_000).select((F.col("id") % 997).alias("g"), F.col("id").alias("x"))
    plan = with_next(df, ["g"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "__chunk" not in plan


def test_a_heavy_group_costs_one_exchange_of_its_rows(spark):
    """Half the rows in one group: they are cut up, and still cross the network once."""
    df = spark.range(10_000).select(F.when(F.col("id") < 5_000, 0).otherwise(F.col("id")).alias("g"), F.col("id").alias("x"))
    made = with_next(df, ["g"], ["x"])
    plan = plan_of(made, executed=True).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastExchange") == 1
    assert made.where(F.col(f"{NEXT}.x") == F.col("x") + 1).count() == 4_999


@pytest.mark.parametrize("seed", range(3))
def test_chunks_of_many_heavy_groups_with_ties(spark, seed):
    """Three heavy groups, heavy values inside them, two sort columns with NULLs, texts and times."""
    draw = random.Random(seed)
    data = [(draw.choice(["a", "b", None]), draw.choice([None, "x", "y", *map(str, range(30))]), draw.choice([None, 1.5, float("inf")]))
            for _ in range(700)]
    data += [("a", "17", 1.5)] * 300
    df = spark.createDataFrame(data, "g string, x string, y double")
    found = single_rows(with_next(df, ["g"], ["x", "y"]))
    groups: dict = {}
    for g, x, y in data:
        groups.setdefault(g, []).append((x, y))
    expected = Counter()
    for g, members in groups.items():
        members.sort(key=lambda m: [(v is None, v if v is not None else 0) if v is None or not isinstance(v, str) else (False, v) for v in m[:1]]
                     + [(m[1] is None, m[1] if m[1] is not None else 0)])
        expected.update((g, *here, after) for here, after in zip(members, members[1:] + [None], strict=True))
    assert Counter((r.g, r.x, r.y, None if r[NEXT] is None else tuple(r[NEXT])) for r in found.collect()) == expected


def test_rows_that_only_a_sort_takes_for_equal_keep_their_spelling(spark):
    df = spark.createDataFrame([("a", 0.0), ("A", -0.0), ("b", 3.0), ("B", 3.0), ("a", -0.0)], "g string, x double")
    df = df.withColumn("g", F.col("g").cast("string collate UTF8_LCASE"))
    found = single_rows(with_next(df, ["g"], ["x"])).select(F.col("g").cast("string").alias("g"), F.col("x").cast("string").alias("x"))
    assert Counter((r.g, r.x) for r in found.collect()) == Counter([("a", "0.0"), ("A", "-0.0"), ("b", "3.0"), ("B", "3.0"), ("a", "-0.0")])


@pytest.mark.parametrize("gaps", ["allowed", "not_allowed", "required"])
@pytest.mark.parametrize("zero_length", [False, True])
def test_range_check_agrees_with_one_window(spark, gaps, zero_length):
    data = [(g, x, None if y is None or x is None else x + y - 1) for g, x, y in skewed_rows(4)]
    df = spark.createDataFrame(data, "g string, lo int, hi int")
    window = Window.partitionBy("g").orderBy(F.col("lo").asc_nulls_last(), F.col("hi").asc_nulls_last())
    after = df.withColumn("after", F.lead("lo").over(window)).withColumn("last", F.lead(F.lit(1)).over(window).isNull())
    follows = {"allowed": "hi <= after", "not_allowed": "hi = after", "required": "hi < after"}[gaps]
    good = f"coalesce({'lo <= hi' if zero_length else 'lo < hi'}, false) and coalesce({follows}, last)"
    expected = bag(after.where(f"not ({good})").select("g", "lo", "hi"))
    found = mutually_exclusive_ranges(df, "lo", "hi", "g", gaps, zero_length)
    assert bag(found.select("partition_by_col", "lower_bound", "upper_bound")) == expected and expected


@pytest.mark.parametrize("interval", [0, 1])
def test_sequence_check_agrees_with_one_window(spark, interval):
    df = spark.createDataFrame(skewed_rows(5), "g string, x int, y int")
    window = Window.partitionBy("g").orderBy("x")
    expected = df.where("x is not null").withColumn("previous_x", F.lag("x").over(window)).where(f"x <> previous_x + {interval}")
    found = sequential_values(df, "x", interval, group_by=["g"])
    assert found.columns == ["g", "x", "previous_x"]
    assert bag(found) == bag(expected.select("g", "x", "previous_x")) and not found.isEmpty()
